"""Structured Streaming forms of resume and append: result files are consumed as they land."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparquill.operators.tasks import Task, responses


def landed_lines(spark: SparkSession, folder: str, files_per_trigger: int = 64) -> DataFrame:
    rows = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)
    return rows.where(F.length(F.trim("value")) > 0).select(F.col("value").alias("line"))


def consume_stream(spark: SparkSession, folder: str, task: Task, source: DataFrame, out: str, failed: str, checkpoint: str) -> StreamingQuery:
    """Append parsed responses to ``out`` and bad ones to ``failed``; what the checkpoint has seen is not consumed again.

    A batch that is run again after a failure replaces its own folder, so each file's rows appear once.
    """
    src = source.select("row_idx", F.struct(*source.columns).alias("source"))

    def sink(batch: DataFrame, number: int) -> None:
        rows = batch.join(src, "row_idx", "left").withColumn("error", F.coalesce("error", F.when(F.col("source").isNull(), "row out of range")))
        rows = rows.persist()
        rows.where("error IS NULL").drop("error").write.mode("overwrite").json(f"{out}/batch={number:08d}")
        rows.where("error IS NOT NULL").select("custom_id", "row_idx", "error").write.mode("overwrite").json(f"{failed}/batch={number:08d}")
        rows.unpersist()

    return responses(landed_lines(spark, folder), task).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_by_id(stream: DataFrame, key: str, event_time: str, delay: str = "1 day") -> DataFrame:
    """Rows of a stream once per key within the watermark; a time without zone is taken as it is."""
    return stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def counts_by_window(events: DataFrame, event_time: str, width: str, delay: str, *keys: str) -> DataFrame:
    """Watermarked tumbling counts, such as responses per state and hour."""
    timed = events.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay)
    return timed.groupBy(F.window(event_time, width), *keys).agg(F.count("*").alias("n"))
