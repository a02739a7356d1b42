"""JSON-lines, TSV and row-range sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparquill.functions.values import range_of_file
from sparquill.runtime import exists_nonempty


def with_row_idx(df: DataFrame, *order: str) -> DataFrame:
    """Adds ``row_idx`` 0, 1, ... in the given order (default: file, then place in it).

    Partition counts are summed on the driver (one number per partition), so no task sees all rows.
    """
    from sparquill.runtime import write_table

    kept = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")) if not order else df
    keys = list(order) or ["_file", "_block"]
    part = kept.withColumn("_i", F.monotonically_increasing_id())
    if order:
        part = kept.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_i", F.monotonically_increasing_id())
        groups = ["_p"]
    else:
        groups = ["_file", "_block"]
    part = write_table(part.withColumn("_p", F.shiftright("_i", 33).cast("long")), "row-idx")
    counts = part.groupBy(*dict.fromkeys([*groups, "_p"])).agg(F.count("*").alias("_n"), F.min("_i").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(*groups).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.withColumn("_before", before).drop("_n")
    out = part.join(F.broadcast(offsets), [*dict.fromkeys([*groups, "_p"])])
    return out.withColumn("row_idx", F.col("_before") + F.col("_i") - F.col("_first")).drop("_i", "_p", "_before", "_first", "_file", "_block")


def read_objects(spark: SparkSession, path: str, schema: str, mode: str = "FAILFAST") -> DataFrame:
    """Objects of a JSON-lines file.  ``FAILFAST`` stops at a bad line, ``DROPMALFORMED`` drops it, ``PERMISSIVE`` gives nulls."""
    return spark.read.schema(schema).option("mode", mode).json(path)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Non-blank raw lines ``(line)`` of one path or several, such as batch results."""
    return spark.read.text(path).where(F.length(F.trim("value")) > 0).select(F.col("value").alias("line"))


def checked_objects(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(objects, bad lines with their number in the file's partition order): arrays and scalars are dropped, broken JSON reported."""
    lines = with_row_idx(spark.read.text(path)).withColumn("line_no", F.col("row_idx") + 1)
    lines = lines.where(F.length(F.trim("value")) > 0).withColumn("v", F.try_parse_json("value"))
    good = lines.where(F.col("v").isNotNull() & F.trim("value").startswith("{")).select(F.from_json("value", schema).alias("o"), "row_idx").select("o.*", "row_idx")
    return good, lines.where(F.col("v").isNull()).select("line_no", F.col("value").alias("line"))


def done_ids(spark: SparkSession, path: str) -> DataFrame:
    """``question_id`` of rows already written; broken lines are skipped, a missing file gives none."""
    if not exists_nonempty(spark, path):
        return spark.createDataFrame([], "question_id string")
    rows = spark.read.schema("question_id string").option("mode", "DROPMALFORMED").json(path)
    return rows.select(F.trim("question_id").alias("question_id")).where(F.length("question_id") > 0).distinct()


def read_job_map(spark: SparkSession, path: str) -> DataFrame:
    """``(jsonl, meta, batch_id, status, input_file_id)``; header, blank and short lines are skipped."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).where((F.length(F.trim("value")) > 0) & (F.size(parts) >= 3)).select(*(F.try_element_at(parts, F.lit(k + 1)).alias(n) for k, n in enumerate(("jsonl", "meta", "batch_id", "status", "input_file_id"))))
    return rows.where("jsonl <> 'jsonl'").withColumn("range", range_of_file("jsonl"))


def write_objects(df: DataFrame, path: str, mode: str = "overwrite", order: str | None = None) -> None:
    """JSON lines, nulls kept; with ``order`` sorted by it (ranges over part files)."""
    rows = df.repartitionByRange(order).sortWithinPartitions(order) if order else df
    rows.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_document(one_row: DataFrame, path: str) -> None:
    one_row.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_requests(requests: DataFrame, path: str, chunk: int, start: int = 0) -> DataFrame:
    """Request lines ``(row_idx, line)`` in one folder per chunk of row numbers, named by its range; empty chunks do not exist.

    Returns ``(name, n_requests)`` and raises if there is no request at all.
    """
    first = (F.floor((F.col("row_idx") - start) / chunk) * chunk + start).cast("long")
    rows = requests.withColumn("name", F.format_string("%06d_%06d", first, first + chunk))
    rows.repartition("name").sortWithinPartitions("name", "row_idx").select("line", "name").write.mode("overwrite").partitionBy("name").text(path)
    counts = rows.groupBy("name").agg(F.count("*").alias("n_requests"))
    if counts.isEmpty():
        raise ValueError("no requests to write")
    return counts


def write_request_file(requests: DataFrame, path: str) -> int:
    """All request lines ``(row_idx, line)`` as one file in order, for a range that a service takes at once; their number.

    One task writes it: ranges beyond a service's limit belong to :func:`write_requests`.
    """
    requests.repartition(1).sortWithinPartitions("row_idx").select("line").write.mode("overwrite").text(path)
    n = requests.sparkSession.read.text(path).count()
    if not n:
        raise ValueError("no requests to write")
    return n


def require_nonempty(spark: SparkSession, path: str, label: str) -> None:
    if not exists_nonempty(spark, path):
        raise RuntimeError(f"{label} missing or empty: {path}")


def refuse_nonempty(spark: SparkSession, path: str, overwrite: bool = False) -> None:
    if not overwrite and exists_nonempty(spark, path):
        raise FileExistsError(f"{path} is not empty; pass overwrite=True")


def write_evaluation(claims: DataFrame, items: DataFrame, summary: DataFrame, augmented: DataFrame | None, prefix: str) -> None:
    """The outputs of an evaluation beside each other."""
    write_objects(claims, f"{prefix}_per_claim")
    write_objects(items, f"{prefix}_per_item")
    write_document(summary, f"{prefix}_summary")
    if augmented is not None:
        write_objects(augmented, f"{prefix}_augmented")
