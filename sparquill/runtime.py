"""Session helpers: the folder executors share, and tables written there to cut lineage."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_tables: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a folder of its own only where that is unset, in local mode."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        current = sc._jsc.sc().getCheckpointDir()
        named = current.get() if current.isDefined() else None
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = "file://" + os.path.join(tempfile.gettempdir(), f"sparquill-{os.getpid()}")
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists_nonempty(spark: SparkSession, path: str) -> bool:
    """Whether a path exists and holds a byte outside hidden files."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return False
    files = fs.listFiles(target, True)
    while files.hasNext():
        f = files.next()
        if f.getLen() > 0 and not f.getPath().getName().startswith(("_", ".")):
            return True
    return False


def write_table(df: DataFrame, label: str) -> DataFrame:
    """Materialise ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/sparquill/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    if not _tables:
        atexit.register(_drop_all)
    _tables.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._sparquill_path = path
    return out


def drop_table(df: DataFrame | None) -> None:
    """Delete a table of :func:`write_table` that nothing will read again."""
    path = getattr(df, "_sparquill_path", None)
    if path is not None:
        delete(df.sparkSession, path)
        _tables[:] = [x for x in _tables if x[1] != path]


def _drop_all() -> None:
    for spark, path in list(_tables):
        try:
            delete(spark, path)
        except Exception:  # the session has ended; its folder goes with it
            return


#: Tables below this many bytes stay as they are split.
SMALL_BYTES = 4 << 20


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt out evenly if the files of ``df`` have fewer row groups than the session has cores.

    A Parquet file is split at its row groups only, so a table of one large group is one task.  Tables of
    many files or groups, and small ones, are returned as they are; only then are footers not even read.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < SMALL_BYTES:
        return df
    files = df.inputFiles()
    if len(files) >= cores:
        return df
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    groups = 0
    for name in files:
        footer = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name)), conf))
        groups += footer.getFooter().getBlocks().size()
        footer.close()
    return df if groups >= cores else df.repartition(cores)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{table}.parquet"))
