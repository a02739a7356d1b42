"""Text normalisation, segmentation and counting as Column expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: patterns of the data model ------------------------------------------------
WORD_PATTERN = r"\b[0-9A-Za-z][0-9A-Za-z'\-]*\b"
SENTENCE_ENDS, UNIT_ENDS = ".!?", "。.!?"
SENTENCE_END = rf"(?U)(?<=[{SENTENCE_ENDS}])\s+"
UNIT_END = rf"(?U)(?<=[{UNIT_ENDS}])\s+"
TRUNCATED = " ...[truncated]"
PUNCTUATION = ".,;:()[]"
# ---------------------------------------------------------------------------------------------

_EDGES = r"(?U)^\s+|\s+$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text(c: Column | str) -> Column:
    """As a string, null as empty."""
    return F.coalesce(col(c).cast("string"), F.lit(""))


def strip(c: Column | str) -> Column:
    """Without white space (any Unicode kind) at both ends."""
    return F.regexp_replace(col(c), _EDGES, "")


def norm_ws(c: Column | str) -> Column:
    """White-space runs as one blank, ends stripped, null as empty."""
    return strip(F.regexp_replace(text(c), r"(?U)\s+", " "))


def has_text(c: Column | str) -> Column:
    """Whether :func:`norm_ws` leaves anything; looks no further than the first character that is no white space."""
    return text(c).rlike(r"(?U)\S")


def norm_value(c: Column | str, falsy: tuple = (0, False)) -> Column:
    """:func:`norm_ws` of a scalar where zero and false count as missing."""
    base = norm_ws(c)
    as_text = col(c).cast("string")
    return F.when(as_text.isin("0", "0.0", "false"), "").otherwise(base)


def clean_text(c: Column | str) -> Column:
    """Line ends unified, blanks collapsed, blank space around line ends and at the ends removed."""
    s = F.translate(text(c), "\r", "\n")
    s = F.regexp_replace(s, "[ \t]+", " ")
    s = F.regexp_replace(s, r"(?U)\s+\n", "\n")
    s = F.regexp_replace(s, r"(?U)\n\s+", "\n")
    return strip(s)


def clean_passage(c: Column | str) -> Column:
    """One line: :func:`norm_ws`."""
    return norm_ws(c)


def normalize_page(c: Column | str) -> Column:
    """Extracted page text: hyphenated line ends joined, paragraph breaks kept, other line ends blanks."""
    s = F.translate(text(c), "\r", "\n")
    s = F.regexp_replace(s, r"-\n(?=[a-z])", "")
    s = F.regexp_replace(s, r"(?U)\n\s*\n+", "\u0001")
    s = F.regexp_replace(s, "\n+", " ")
    s = strip(F.regexp_replace(s, "[ \t]+", " "))
    return F.regexp_replace(s, "\u0001", "\n\n")


def count_words(c: Column | str) -> Column:
    return F.regexp_count(text(c), F.lit(WORD_PATTERN)).cast("int")


def _parts(s: Column, pattern: str) -> Column:
    return F.filter(F.transform(F.split(s, pattern), strip), lambda x: F.length(x) > 0)


def sentences(c: Column | str) -> Column:
    """Sentences of the one-line text."""
    return _parts(clean_passage(c), SENTENCE_END)


def units(c: Column | str) -> Column:
    """Units of a page for chunking: pieces that end with sentence punctuation before white space."""
    return _parts(clean_text(c), UNIT_END)


def words(c: Column | str) -> Column:
    """White-space separated tokens."""
    s = norm_ws(c)
    return F.when(F.length(s) == 0, F.array().cast("array<string>")).otherwise(F.split(s, " "))


def tail_overlap(c: Column | str, n_sentences: int = 1, max_words: int = 40) -> Column:
    """The last sentences, cut to their last ``max_words`` tokens."""
    if n_sentences <= 0:
        return F.lit("")
    last = F.array_join(F.slice(F.reverse(sentences(c)), 1, n_sentences), "\u0001")
    ordered = F.array_join(F.reverse(F.split(last, "\u0001")), " ")
    own = words(ordered)
    return F.when(F.size(own) > max_words, F.array_join(F.slice(own, -max_words, max_words), " ")).otherwise(strip(ordered))


def truncate(c: Column | str, max_chars: int) -> Column:
    """One line of at most ``max_chars`` characters and a mark if cut; zero or less: whole."""
    if max_chars <= 0:
        return norm_ws(c)
    cut = lambda s: F.regexp_replace(F.substring(s, 1, max_chars), r"(?U)\s+$", "")
    whole, most = text(c), 2 * max_chars + 64
    # A beginning that is too long in one line already tells the whole line's; the whole is read where it is not.
    start = let(norm_ws(F.substring(whole, 1, most)), lambda s: F.when((F.length(s) > max_chars) | (F.length(whole) <= most), s).otherwise(norm_ws(whole)))
    return let(start, lambda s: F.when(F.length(s) > max_chars, F.concat(cut(s), F.lit(TRUNCATED))).otherwise(s))


def cut_at_word(c: Column | str, max_chars: int) -> Column:
    """At most ``max_chars`` characters, back to the last blank if cut."""
    s = text(c)
    if max_chars <= 0:
        return s
    cut = strip(F.regexp_replace(F.substring(s, 1, max_chars), " [^ ]*$", ""))
    return F.when(F.length(s) > max_chars, cut).otherwise(s)


def compact_list(c: Column | str, max_items: int = 8) -> Column:
    """The first items, blank ones then dropped, joined by semicolons."""
    kept = F.filter(F.transform(F.slice(F.coalesce(col(c), F.array().cast("array<string>")), 1, max_items), norm_ws), lambda x: F.length(x) > 0)
    return F.array_join(kept, "; ")


def join_list(c: Column | str) -> Column:
    """Non-blank items, stripped, joined by semicolons."""
    kept = F.filter(F.transform(F.coalesce(col(c), F.array().cast("array<string>")), lambda x: strip(text(x))), lambda x: F.length(x) > 0)
    return F.array_join(kept, "; ")


def clean_list(c: Column | str) -> Column:
    """Items one-lined, blank ones dropped; null as empty."""
    return F.filter(F.transform(F.coalesce(col(c), F.array().cast("array<string>")), norm_ws), lambda x: F.length(x) > 0)


def items_of(df: DataFrame, c: str) -> Column:
    """Items of a column that is a list, or the one value of a column that is none; blank ones dropped."""
    listed = isinstance(df.schema[c].dataType, T.ArrayType)
    return clean_list(c) if listed else clean_list(F.array(col(c).cast("string")))


def distinct_ignoring_case(c: Column | str) -> Column:
    """Items in order, later ones that equal an earlier one but for case dropped."""
    empty = F.array().cast("array<string>")
    return F.aggregate(
        F.coalesce(col(c), empty), empty, lambda kept, x: F.when(F.exists(kept, lambda y: F.lower(y) == F.lower(x)), kept).otherwise(F.concat(kept, F.array(x)))
    )


def first_text(*cs: Column | str) -> Column:
    """The first non-blank of several fields, stripped; empty if all are blank."""
    return F.coalesce(*(F.when(F.length(s) > 0, s) for s in (strip(text(c)) for c in cs)), F.lit(""))


def punctuation_share(c: Column | str) -> Column:
    s = text(c)
    return (F.length(s) - F.length(F.translate(s, PUNCTUATION, ""))) / F.greatest(F.length(s), F.lit(1))
