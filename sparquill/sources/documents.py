"""Paged documents from binary files, with a pluggable extractor, and the vector index."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.functions.text import normalize_page


def pypdf_pages(content: bytes) -> list[str]:
    """Page texts of a PDF; needs pypdf on the executors."""
    import io

    from pypdf import PdfReader

    return [page.extract_text() or "" for page in PdfReader(io.BytesIO(content)).pages]


def text_pages(content: bytes) -> list[str]:
    """Pages of plain text, parted by form feeds."""
    return content.decode("utf-8", "replace").split("\f")


def read_pages(spark: SparkSession, folder: str, pattern: str = "*.pdf", extract: Callable[[bytes], list[str]] = pypdf_pages) -> DataFrame:
    """``(guideline_id, source_pdf, pages, error)``, one row per file; a file that fails has an error and no pages."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "content")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    pages, error = [p or "" for p in extract(content)], None
                except Exception as e:  # one broken file spoils only itself
                    pages, error = None, f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([pages], pa.list_(pa.string())), pa.array([error], pa.string())], names=["source_pdf", "pages", "error"])

    rows = files.mapInArrow(scan, "source_pdf string, pages array<string>, error string")
    name = F.regexp_replace(F.regexp_extract("source_pdf", r"([^/]*)$", 1), r"\.[^.]*$", "")
    return rows.select(name.alias("guideline_id"), "source_pdf", F.transform("pages", normalize_page).alias("pages"), "error")


def write_index(rows: DataFrame, path: str, overwrite: bool = False) -> None:
    """The index as a table: the vector stands on its passage's row, so both always agree."""
    rows.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path)
    if "embedding" not in rows.columns:
        raise ValueError("an index needs an embedding column")
    return rows
