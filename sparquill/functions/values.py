"""Ids, sets and vectors as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparquill.functions.text import col, first_text, strip, text


def padded_id(prefix: str, n: Column | str, width: int = 6) -> Column:
    return F.format_string(f"{prefix}%0{width}d", col(n).cast("long"))


def passage_id(document: Column | str, n: Column | str) -> Column:
    return F.format_string("%s_p%05d", col(document), col(n).cast("long"))


def group_of_passage(explicit: Column | str, passage: Column | str) -> Column:
    """Document of a passage for pools: the field, else what stands before ``_p``, else ``unknown``."""
    p = text(passage)
    return F.when(F.length(text(explicit)) > 0, text(explicit)).when(p.contains("_p"), F.split_part(p, F.lit("_p"), F.lit(1))).otherwise("unknown")


def document_of_passage(passage: Column | str, *explicit: Column | str) -> Column:
    """Document of a passage for the index: the first non-blank field, else what stands before the first ``_``."""
    found = first_text(*explicit) if explicit else F.lit("")
    p = text(passage)
    return F.when(F.length(found) > 0, found).when(p.contains("_"), F.split_part(p, F.lit("_"), F.lit(1))).otherwise("")


def number_after(c: Column | str, prefix: str) -> Column:
    """The number of a custom id such as ``passage-12``; null if it has another form."""
    return F.regexp_extract(text(c), rf"^{prefix}-(-?\d+)$", 1).try_cast("long")


def range_of_file(c: Column | str) -> Column:
    """(start, end) of a file name that ends ``_000000_000100`` before its suffix; nulls without it."""
    stem = F.regexp_replace(F.regexp_extract(text(c), r"([^/]*)$", 1), r"\.[^.]*$", "")
    part = lambda k: F.regexp_extract(stem, r"_(\d{6})_(\d{6})$", k).try_cast("int")
    return F.struct(part(1).alias("start"), part(2).alias("end"))


def time_tag(c: Column | None = None) -> Column:
    return F.date_format(F.current_timestamp() if c is None else c, "yyyyMMdd_HHmmss")


def jaccard(a: Column | str, b: Column | str) -> Column:
    """Of two id sets; 0 if either is empty."""
    x, y = F.array_distinct(col(a)), F.array_distinct(col(b))
    return F.when((F.size(x) < 1) | (F.size(y) < 1), 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product in double precision."""
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(c: Column | str) -> Column:
    """The vector at length one; a zero vector stays."""
    norm = F.sqrt(dot(c, c))
    return F.transform(col(c), lambda x: x.cast("double") / F.when(norm == 0, 1.0).otherwise(norm))


def yes_share(yes: Column | str, no: Column | str) -> Column:
    """Softmax of two logits: the share of yes."""
    return 1 / (1 + F.exp(col(no) - col(yes)))


def rate(n: Column | str, of: Column | str) -> Column:
    """n / of, null for of = 0."""
    return col(n) / F.when(col(of) != 0, col(of))


def rounded(c: Column | str, places: int = 6) -> Column:
    return F.round(col(c), places)


def one_of(c: Column | str, allowed: tuple[str, ...], otherwise: Column | str) -> Column:
    s = strip(text(c))
    return F.when(s.isin(*allowed), s).otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
