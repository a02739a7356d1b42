"""Citation marks ``[n]``: extraction, clamping, and splitting answers into cited sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparquill.functions.text import col, norm_ws, strip, text

# --- fixed values: the citation format of the data model ---------------------------------------
MARK = r"\[(\d+)\]"
CITED_SENTENCE = r"(?s)(.+?[.!?。！？]\s*(?:\[\d+\]){1,3})(?=\s+|$)"
MAX_CITATIONS = 3
# ---------------------------------------------------------------------------------------------


def marks(c: Column | str) -> Column:
    """All cited numbers in order, repeats included."""
    found = F.regexp_extract_all(text(c), F.lit(MARK), F.lit(1))
    return F.filter(F.transform(found, lambda x: x.try_cast("int")), lambda n: n.isNotNull())


def citation_ids(c: Column | str) -> Column:
    """Distinct positive cited numbers in order."""
    return F.array_distinct(F.filter(marks(c), lambda n: n > 0))


def clamp(ids: Column | str, most: Column | int) -> Column:
    """At most three distinct numbers within 1..most; null as none."""
    top = most if isinstance(most, Column) else F.lit(most)
    inside = F.filter(F.coalesce(col(ids), F.array().cast("array<int>")), lambda n: n.isNotNull() & (n >= 1) & (n <= top))
    return F.slice(F.array_distinct(inside), 1, MAX_CITATIONS)


def without_marks(c: Column | str) -> Column:
    """The one-line text without citation marks at its end."""
    return strip(F.regexp_replace(norm_ws(c), r"\s*(?:\[\d+\])+\s*$", ""))


def sentence_number(c: Column | str, otherwise: Column) -> Column:
    """The first number in an id, else the given ordinal."""
    return F.coalesce(F.regexp_extract(text(c), r"(\d+)", 1).try_cast("int"), otherwise)


def cited_sentences(c: Column | str) -> Column:
    """Pieces of an answer that end with sentence punctuation and one to three marks."""
    return F.transform(F.regexp_extract_all(norm_ws(c), F.lit(CITED_SENTENCE), F.lit(1)), norm_ws)
