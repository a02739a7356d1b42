"""Corpus pipeline: quality, near-dedup, decontamination, PII, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's
result as Parquet in the shared folder and reads it back as the next one's input.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.llm._runtime import read, write_table
from sparquill.llm.decontam import contamination, short_items
from sparquill.llm.packing import pack
from sparquill.llm.pii import redacted
from sparquill.llm.quality import selected, train
from sparquill.llm.simhash import near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal quality model, trained on ``labels``, rejects go; so do those without words."""
    return selected(docs, train(docs, read(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    Of rows that share the id that stays, all whose fingerprint links them to the group stay if their
    texts differ; of rows equal in id and text one stays, the smallest by its other columns.
    Documents with a null id stay: they cannot be named as copies.  Null and empty texts have
    fingerprint zero and are copies of each other.
    """
    found = near_duplicates(docs).where("doc_id IS NOT NULL")
    flagged = found.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("_near_dedup_stays"), (F.count("*") > 1).alias("_near_dedup_again"))
    flagged = flagged.where("NOT _near_dedup_stays OR _near_dedup_again")
    named = docs.where("doc_id IS NOT NULL").join(flagged, "doc_id", "left")  # the texts are moved once, by id
    single = named.where("_near_dedup_stays IS NULL").select(*docs.columns)
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    again = named.where("_near_dedup_stays AND _near_dedup_again").groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0).alias("_near_dedup_stays"), *rest)).alias("_near_dedup_again"))
    least = [F.col(c) if c in ("doc_id", "text") else F.col("_near_dedup_again").getField(c).alias(c) for c in docs.columns]
    return single.unionByName(again.select(*least)).unionByName(docs.where("doc_id IS NULL"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which any window of a benchmark item occurs go: one leaked item is a leak.

    An item shorter than a window may be a common phrase: it counts only beside a further item.
    The decision is each row's own, by its text: null ids are judged like others, and of rows that
    share an id only those with a leak go.
    """
    benchmark = read(spark, sf_dir, "benchmark")
    found = contamination(docs, benchmark, keep_row=True)
    short = F.array(*map(F.lit, short_items(benchmark))).cast("array<long>")
    leaked = (F.size("items") > 1) | (F.size(F.array_except("items", short)) > 0)
    return found.where(~leaked).select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kind in angle brackets; no document goes."""
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 ids."""
    return pack(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("pii", pii), ("packing", packing)]

#: The tokenizer, the trained models and XXH64 are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return docs
