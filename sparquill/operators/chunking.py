"""Section-aware passages from paged documents.

Every step depends on what came before it in the document (the running section, carried overlap, a
chunk's predecessor), so a document goes through them in turn, in Arrow batches: units, headings, the
chunk fold, reference scores and tail merges in one pass.  Documents are rows, so nothing shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparquill.functions.reference_score import THRESHOLD, Bibliography, Headings
from sparquill.functions.text import SENTENCE_ENDS, UNIT_ENDS, normalize_page
from sparquill.functions.values import passage_id

TAIL_SLACK = 80
#: Documents whose results are held before they go on.
BATCH = 64
_FIELDS = ("section_title", "page_start", "page_end", "para_start", "para_end", "text", "word_count")
_CHUNK = "struct<section_title:string,page_start:int,page_end:int,para_start:int,para_end:int,text:string,word_count:int,score:double>"
_CHUNKS = pa.list_(
    pa.struct([("section_title", pa.string()), ("page_start", pa.int32()), ("page_end", pa.int32()), ("para_start", pa.int32()), ("para_end", pa.int32()), ("text", pa.string()), ("word_count", pa.int32()), ("score", pa.float64())])
)


def _listed(chunks: list[list[dict]]) -> pa.Array:
    """Lists of chunks, built column by column."""
    ends = list(accumulate(map(len, chunks), initial=0))
    fields = _CHUNKS.value_type
    columns = [pa.array([c[f.name] for own in chunks for c in own], f.type) for f in fields]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(fields)), type=_CHUNKS)


def pages_of(page_rows: DataFrame, document: str = "guideline_id", page: str = "page_no", text: str = "text") -> DataFrame:
    """One row per document with its page texts in order, from one row per page."""
    pages = F.transform(F.array_sort(F.collect_list(F.struct(F.col(page).alias("n"), F.coalesce(F.col(text), F.lit("")).alias("t")))), lambda p: p["t"])
    return page_rows.groupBy(document).agg(pages.alias("pages"))


def units_of(page: str | None) -> list[str]:
    """Units of a page, each in one line: pieces that end with sentence punctuation before white space."""
    # With all white space as single blanks, a unit ends where punctuation stands before a blank.
    whole = " ".join((page or "").split())
    for end in UNIT_ENDS:
        whole = whole.replace(end + " ", end + "\n")
    return whole.split("\n") if whole else []


class Units:
    """Units of documents with their marks: (page, para, text, words, is_reference, is_heading)."""

    def __init__(self) -> None:
        self.headings, self.bibliography = Headings(), Bibliography()

    def __call__(self, pages: list[str | None]) -> Iterator[tuple[int, int, str, int, bool, bool]]:
        for p, page in enumerate(pages, 1):
            texts = units_of(page)
            for k, (text, words) in enumerate(zip(texts, self.bibliography.words_each(texts), strict=True), 1):
                yield p, k, text, words, self.headings.reference(text), self.headings.section(text, words)


def unit_rows(docs: DataFrame, normalize: bool = False) -> DataFrame:
    """``docs(guideline_id, pages)`` to its units in order: page, para, text, words, is_reference, is_heading, the
    section's title (the last heading so far) and whether a reference heading came before or is the unit.

    Null pages and pages without units give no rows; repeated documents each give theirs.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units()
        kinds = {"guideline_id": pa.string(), "page": pa.int32(), "para": pa.int32(), "text": pa.string(), "words": pa.int32(), "is_reference": pa.bool_(), "is_heading": pa.bool_(), "section_title": pa.string(), "in_references": pa.bool_()}
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                rows = []
                for name, pages in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    title, ended = "", False
                    for u in units(pages or []):
                        title = u[2][:160] if u[5] and not u[4] else title
                        ended = ended or u[4]
                        rows.append((name, *u, title, ended))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)], names=list(kinds))

    pages = F.transform(F.col("pages"), normalize_page) if normalize else F.col("pages")
    return docs.select(F.col("guideline_id").cast("string"), pages.alias("pages")).mapInArrow(
        scan, "guideline_id string, page int, para int, text string, words int, is_reference boolean, is_heading boolean, section_title string, in_references boolean"
    )


def overlap_of(text: str, n_sentences: int, max_words: int = 40) -> str:
    """The last sentences, at most their last ``max_words`` tokens: a sentence ends with a token that ends with its punctuation."""
    if n_sentences <= 0:
        return ""
    own = text.rsplit(None, max_words)[-max_words:]
    for k in range(len(own) - 1, 0, -1):
        if own[k - 1][-1] in SENTENCE_ENDS:
            n_sentences -= 1
            if not n_sentences:
                return " ".join(own[k:])
    return " ".join(own)


def fold_units(units: list[tuple], max_words: int, overlap: int, words_of) -> tuple[list[dict], int]:
    """Chunks of one document and the number of units in its reference section (to its end)."""
    chunks: list[dict] = []
    section, texts, words, span = "", [], 0, [0, 0, 0, 0]

    def flush() -> str:
        nonlocal texts, words
        if not texts:
            return ""
        whole = " ".join(texts)
        chunks.append(dict(zip(_FIELDS, (section, span[0], span[1], span[2], span[3], whole, words), strict=True)))
        texts, words = [], 0
        return whole

    for k, (page, para, text, n, is_reference, is_heading) in enumerate(units):
        if is_reference:
            flush()
            return chunks, len(units) - k
        if is_heading:
            flush()
            section = text[:160]
            continue
        if not texts:
            span = [page, page, para, para]
        texts.append(text)
        words += n
        span[1], span[3] = page, para
        if words >= max_words:  # a trigger, not a cap
            carried = overlap_of(flush(), overlap)
            if carried:
                texts, words = [carried], words_of(carried)
                span = [page, page, para, para]
    flush()
    return chunks, 0


def merged_tails(chunks: list[dict], min_words: int, max_words: int) -> list[dict]:
    """Short chunks joined to the one before them in the same section; a joined chunk has no score yet."""
    out: list[dict] = []
    for c in chunks:
        last = out[-1] if out else None
        if last and c["word_count"] < min_words and last["section_title"] == c["section_title"] and last["word_count"] + c["word_count"] <= max_words + TAIL_SLACK:
            out[-1] = last | {"page_end": c["page_end"], "para_end": c["para_end"], "text": last["text"] + " " + c["text"], "word_count": last["word_count"] + c["word_count"], "score": None}
        else:
            out.append(c)
    return out


_COUNTS = ("num_raw_candidate_chunks", "removed_by_ref_heading_zone", "removed_by_regex_ref", "num_kept_chunks_before_tail_merge", "removed_by_regex_ref_after_tail_merge", "num_kept_chunks_after_tail_merge")


def passages(
    docs: DataFrame, min_words: int = 100, max_words: int = 220, overlap_sentences: int = 1, threshold: float = THRESHOLD, normalize: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``docs(guideline_id, source_pdf, pages)`` to (passages, counts per document).

    Chunks flush at ``max_words``; a short chunk joins the one before it in the same section within
    ``max_words + 80`` words; bibliography-like chunks go before and after that.  Null pages and documents
    without units give no passages but a row of counts.  Each of the two goes through the documents by itself.
    """

    def fold(batches: Iterator[pa.RecordBatch], texts: bool = True) -> Iterator[pa.RecordBatch]:
        units = Units()
        score = units.bibliography.score
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                finals, counts = [], []
                for pages in batch.column(3).to_pylist():
                    raw, zone = fold_units(list(units(pages)), max_words, overlap_sentences, units.bibliography.words)
                    kept = [c for c in (c | {"score": score(c["text"], c["word_count"])} for c in raw) if c["score"] < threshold]
                    merged = [c if c["score"] is not None else c | {"score": score(c["text"], c["word_count"])} for c in merged_tails(kept, min_words, max_words)]
                    final = [c for c in merged if c["score"] < threshold]
                    if texts:
                        finals.append(final)
                    counts.append((len(raw), zone, len(raw) - len(kept), len(kept), len(merged) - len(final), len(final)))
                cols = [pa.array(c, pa.int32()) for c in zip(*counts, strict=True)]
                names = ["guideline_id", "source_pdf", "num_pages", *_COUNTS]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *cols, _listed(finals)], names=[*names, "final"]) if texts else pa.RecordBatch.from_arrays([*batch.columns[:3], *cols], names=names)

    pages = F.coalesce("pages", F.array().cast("array<string>"))
    ready = docs.select(F.col("guideline_id").cast("string"), F.col("source_pdf").cast("string"), F.size(pages).alias("num_pages"), (F.transform(pages, normalize_page) if normalize else pages).alias("pages"))
    kinds = "guideline_id string, source_pdf string, num_pages int, " + ", ".join(f"{c} int" for c in _COUNTS)
    folded = ready.mapInArrow(fold, kinds + f", final array<{_CHUNK}>")
    rows = folded.select("guideline_id", "source_pdf", F.posexplode("final").alias("k", "c"))
    out = rows.select(
        "guideline_id", passage_id("guideline_id", F.col("k") + 1).alias("passage_id"), "source_pdf", *(f"c.{f}" for f in _FIELDS),
        F.col("c.score").alias("reference_list_score"), (F.col("c.score") >= threshold).alias("is_reference_like_by_regex"),
    )
    return out, ready.mapInArrow(partial(fold, texts=False), kinds)  # texts that nobody reads stay with the workers


def model_filter(rows: DataFrame, scorer, threshold: float = 0.80, batch: int = 64) -> DataFrame:
    """Passages that a yes/no model scores below ``threshold``, with the score."""
    scored = scorer.with_score(rows, "text", "qwen_reference_score", batch)
    return scored.withColumn("is_reference_like_by_qwen", F.col("qwen_reference_score") >= threshold).where(~F.col("is_reference_like_by_qwen"))


def corpus_totals(counts: DataFrame) -> DataFrame:
    """One row of totals over all documents."""
    names = [c for c in counts.columns if c not in ("guideline_id", "source_pdf")]
    return counts.agg(F.count("*").alias("num_documents"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names))
