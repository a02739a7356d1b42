"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparquill.runtime import drop_table, read, write_table

__all__ = ["cuts", "drop_table", "labelled_texts", "read", "sliced", "text_columns", "write_table"]


def text_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns of the input can't clash with working names."""
    return df.select(*(F.col(f"`{n}`") for n in names))


def sliced(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``most_bytes`` at most (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        size = values.nbytes
        step = n if size <= most_bytes else max(1, int(n * most_bytes / size))
        for at in range(0, n, step):
            yield batch.slice(at, min(step, n - at))


_BLANK = re.compile(r"[ \t\n\r]")


def cuts(text: str, most: int = 1 << 20) -> list[str]:
    """A text in pieces of ``most`` characters or a little more, cut after blanks, so that no word is cut."""
    out, at = [], 0
    while len(text) - at > most and (m := _BLANK.search(text, at + most)):
        out.append(text[at : m.end()])
        at = m.end()
    return [*out, text[at:]] if out else [text]


def labelled_texts(docs: DataFrame, chosen: DataFrame, label: str, most_bytes: int) -> list[tuple[int, int, str]]:
    """(doc_id, label, text) of the rows that ``chosen(doc_id, label)`` names, a bounded table in order of the id's hash.

    Texts are taken whole, in that order, while they fit ``most_bytes`` together; their lengths are asked for
    first, so that what the driver receives is bounded.  ``chosen`` goes to the documents: no text is shuffled.
    """
    rows = text_columns(docs, "doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    sizes = rows.groupBy("doc_id").agg(F.sum(F.octet_length("text")).alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    take, total = [], 0
    for r in sizes:
        if total + r["n"] > most_bytes and take:
            break
        take.append((r["doc_id"],))
        total += r["n"]
    if not take:
        return []
    fit = docs.sparkSession.createDataFrame(take, "doc_id long")
    return sorted((r["doc_id"], r[label], r["text"]) for r in rows.join(F.broadcast(fit), "doc_id").select("doc_id", label, "text").collect())
