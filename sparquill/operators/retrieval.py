"""Index building, recall, reranking and resume for questions over passages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparquill.functions.text import clean_list, cut_at_word, distinct_ignoring_case, first_text, items_of, join_list, norm_ws, text
from sparquill.functions.values import document_of_passage, padded_id


def _have(df: DataFrame, *names: str) -> list[str]:
    return [n for n in names if n in df.columns]


def _field(df: DataFrame, *names: str) -> Column:
    own = _have(df, *names)
    return first_text(*own) if own else F.lit("")


def _labelled(*pairs: tuple[str, Column]) -> Column:
    """Lines with their label; lines without content vanish."""
    return F.concat_ws("\n", *(F.when(F.length(v) > 0, F.concat(F.lit(label), v)) for label, v in pairs))


def pool_embed_text(use_source: bool = False, max_source_chars: int = 800) -> Column:
    """Text of an annotated passage for pools: five labelled lines, kept even if empty."""
    line = lambda label, v: F.concat(F.lit(label + ": "), v)
    from sparquill.functions.text import strip

    parts = [
        line("Topic", strip(text("main_topic"))), line("Summary", strip(text("semantic_summary"))), line("Question angles", join_list("question_angles")),
        line("Patient keywords", join_list("patient_language_keywords")), line("Content type", strip(text("content_type"))),
    ]
    if use_source:
        source = strip(text("source_text"))
        parts.append(F.when(F.length(source) > 0, line("Source text", F.substring(source, 1, max_source_chars))))
    return F.concat_ws("\n", *parts)


def index_rows(seeds: DataFrame, only_usable: bool = True, keep_text: bool = False) -> DataFrame:
    """Passages for the index, first occurrence of each id in order of ``row_idx``, then those without text gone.

    An empty first occurrence hides later ones.  ``only_usable=False`` indexes unusable passages too.
    """
    if only_usable and "usable" in seeds.columns:
        seeds = seeds.where(F.coalesce(F.col("usable"), F.lit(False)))
    pid = _field(seeds, "passage_id", "id", "chunk_id")
    rows = seeds.withColumn("_pid", F.when(F.length(pid) > 0, pid).otherwise(padded_id("passage_", "row_idx")))
    first = rows.groupBy("_pid").agg(F.min("row_idx").alias("row_idx"))  # partial: a hot id is one row per task
    rows = rows.join(first, ["_pid", "row_idx"], "left_semi")
    keywords = [items_of(rows, c) for c in _have(rows, "patient_language_keywords", "patient_keywords", "keywords", "question_angles", "angles")]
    merged = F.array_join(F.slice(distinct_ignoring_case(F.concat(*keywords)), 1, 20), "; ") if keywords else F.lit("")
    source = norm_ws(_field(rows, "source_text", "text", "passage_text", "content", "chunk_text"))
    embed = _labelled(("Topic: ", norm_ws(_field(rows, "main_topic"))), ("Summary: ", norm_ws(_field(rows, "semantic_summary"))), ("Patient keywords: ", merged), ("Guideline passage: ", source))
    named = {
        "guideline_id": document_of_passage("_pid", *_have(rows, "guideline_id", "pmid", "document_id", "doc_id", "source_id")),
        "source_pdf": _field(rows, "source_pdf"), "section": _field(rows, "section", "section_title"), "content_type": _field(rows, "content_type"), "main_topic": _field(rows, "main_topic"), "semantic_summary": _field(rows, "semantic_summary"),
    }
    other = [F.col(c) for c in _have(rows, "page_start", "page_end", "word_count", "question_angles", "patient_language_keywords")]
    out = rows.select("row_idx", F.col("_pid").alias("passage_id"), *(v.alias(k) for k, v in named.items()), *other, source.alias("text"), embed.alias("embedding_text")).where(F.length("text") > 0)
    return out if keep_text else out


def question_text(df: DataFrame) -> Column:
    return norm_ws(_field(df, "question", "query", "text"))


def _anchored(df: DataFrame, label: str, most: int) -> Column:
    lists = [items_of(df, c) for c in _have(df, "retrieval_anchor_terms", "patient_keywords")]
    terms = F.array_join(F.slice(distinct_ignoring_case(F.concat(*lists)), 1, most), "; ") if lists else F.lit("")
    return F.when(F.length(terms) > 0, F.concat(question_text(df), F.lit(label), terms)).otherwise(question_text(df))


def search_text(df: DataFrame, with_anchors: bool = True) -> Column:
    return _anchored(df, "\nRelevant terms: ", 12) if with_anchors else question_text(df)


def rerank_query(df: DataFrame, with_anchors: bool = False) -> Column:
    return _anchored(df, "\nRelevant medical terms: ", 8) if with_anchors else question_text(df)


def rerank_document(max_chars: int = 2500) -> Column:
    """Passage text for the reranker: labelled lines, cut back to a word end."""
    doc = _labelled(
        ("Topic: ", norm_ws("main_topic")), ("Summary: ", norm_ws("semantic_summary")), ("Patient keywords: ", F.array_join(F.slice(clean_list("patient_language_keywords"), 1, 12), "; ")), ("Guideline passage: ", norm_ws("text"))
    )
    return cut_at_word(doc, max_chars)


def rows_between(df: DataFrame, start: int = 0, end: int = -1) -> DataFrame:
    """Rows with ``start <= row_idx < end``; a negative end is the table's end."""
    kept = df.where(F.col("row_idx") >= max(0, start))
    return kept if end < 0 else kept.where(F.col("row_idx") < end)


def rows_limited(df: DataFrame, start: int = 0, limit: int = 0) -> DataFrame:
    """``limit`` rows from ``start`` on; zero or less: all."""
    return rows_between(df, start, start + limit if limit > 0 else -1)


def pending(questions: DataFrame, done: DataFrame) -> DataFrame:
    """Questions whose (stripped) id is not among the done ones."""
    from sparquill.functions.text import strip

    ids = done.select(strip(text("question_id")).alias("_done")).distinct()
    return questions.join(ids, strip(text("question_id")) == F.col("_done"), "left_anti")


def with_question_ids(questions: DataFrame) -> DataFrame:
    """Blank ids become ``question_<row_idx>``, so a resumed run names the same rows alike."""
    own = _field(questions, "question_id", "id")
    return questions.withColumn("question_id", F.when(F.length(own) > 0, own).otherwise(padded_id("question_", "row_idx")))


def candidates(hits: DataFrame) -> DataFrame:
    """``hits(query_id, rank, passage_id, score)``: of a passage's several hits for a query the best-ranked stays."""
    best = Window.partitionBy("query_id", "passage_id").orderBy("rank")
    return hits.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")


def reranked(scored: DataFrame, k: int) -> DataFrame:
    """``scored(query_id, faiss_rank, faiss_score, rerank_score, ...)``: the k best by rerank score, then recall score, then recall rank."""
    order = Window.partitionBy("query_id").orderBy(F.col("rerank_score").desc(), F.col("faiss_score").desc(), "faiss_rank")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def retrieved(ranked: DataFrame, passages: DataFrame, max_chars: int = 2000) -> DataFrame:
    """``(query_id, retrieved_passages)``: ranked passages with their fields, joined late by id."""
    fields = [c for c in ("guideline_id", "source_pdf", "page_start", "page_end", "section", "content_type", "main_topic", "semantic_summary", "patient_language_keywords") if c in passages.columns]
    rows = ranked.select("query_id", "rank", "passage_id", "faiss_rank", "faiss_score", "rerank_score").join(passages, "passage_id")
    entry = F.struct("rank", "passage_id", *fields, "faiss_rank", "faiss_score", "rerank_score", cut_at_word(norm_ws("text"), max_chars).alias("text"))
    return rows.groupBy("query_id").agg(F.array_sort(F.collect_list(entry)).alias("retrieved_passages"))
