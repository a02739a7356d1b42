"""Command line: one command per stage, for ``spark-submit`` or ``python -m sparquill.cli``.

Stages read and write JSON lines or Parquet folders; defaults are those of the published settings.
"""

from __future__ import annotations

import argparse
import importlib
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.functions.text import first_text, norm_ws
from sparquill.functions.values import group_of_passage
from sparquill.operators import chunking, evaluation, jobs, models, pools, retrieval, tasks, validation, vectors
from sparquill.runtime import write_table
from sparquill.sources import documents, jsonl

def _answer_prompt(rows: DataFrame):
    return tasks.answer_prompt(fields=tuple(c for c in ("question_id", "question_type", "retrieval_anchor_terms", "patient_keywords") if c in rows.columns))


#: Task and its prompt for rows.
_PROMPTS = {
    "seed": (tasks.SEED, lambda rows: tasks.seed_prompt()),
    "question": (tasks.QUESTION, lambda rows: tasks.pool_prompt()),
    "answer": (tasks.ANSWER, _answer_prompt),
    "claims": (tasks.CLAIMS, lambda rows: tasks.claims_prompt(validation.claim_sentences(rows))),
}


def _read(spark: SparkSession, path: str) -> DataFrame:
    """Rows with ``row_idx``; a folder of consumed results may hold a folder per run."""
    rows = spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.option("recursiveFileLookup", "true").json(path)
    return rows if "row_idx" in rows.columns else jsonl.with_row_idx(rows)


def _client(a: argparse.Namespace) -> jobs.Client:
    """The batch service: ``module:function`` names what makes a client; without it the local stand-in."""
    if not a.client:
        return jobs.LocalClient()
    module, _, name = a.client.partition(":")
    return getattr(importlib.import_module(module), name)()


def build_passages(spark: SparkSession, a: argparse.Namespace) -> None:
    jsonl.refuse_nonempty(spark, a.out, a.overwrite)
    extract = documents.pypdf_pages if a.pattern.endswith(".pdf") else documents.text_pages
    files = documents.read_pages(spark, a.input, a.pattern, extract)
    rows, counts = chunking.passages(files.where("error IS NULL"), a.min_words, a.max_words, a.overlap, a.reference_threshold)
    jsonl.write_objects(rows, f"{a.out}/passages")
    jsonl.write_objects(counts, f"{a.out}/counts")
    jsonl.write_objects(files.where("error IS NOT NULL").select("guideline_id", "source_pdf", "error"), f"{a.out}/errors")
    jsonl.write_document(chunking.corpus_totals(counts), f"{a.out}/summary")


def _requests(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    task, prompt = _PROMPTS[a.task]
    rows = retrieval.rows_between(_read(spark, a.input), a.start, a.end)
    return tasks.requests(rows, task, prompt(rows), a.model, a.max_output_tokens, a.temperature)


def build_requests(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.single:
        print(jsonl.write_request_file(_requests(spark, a), a.out))
        return
    counts = jsonl.write_requests(_requests(spark, a), a.out, a.chunk or _PROMPTS[a.task][0].chunk, a.start)
    counts.orderBy("name").show(1000, truncate=False)


def submit(spark: SparkSession, a: argparse.Namespace) -> None:
    jobs.write_job_map(jobs.job_table(spark, [jobs.submit(spark, _client(a), a.input, a.window)]), a.out)


def run_split(spark: SparkSession, a: argparse.Namespace) -> None:
    made = jobs.run_split(spark, _client(a), _requests(spark, a), a.out, a.chunk or _PROMPTS[a.task][0].chunk)
    jobs.write_job_map(jobs.job_table(spark, made), a.out.rstrip("/") + ".batches")


def status(spark: SparkSession, a: argparse.Namespace) -> None:
    jobs.write_job_map(jobs.job_table(spark, jobs.refreshed(jobs.read_jobs(spark, a.input), _client(a))), a.out)


def _consumed(spark: SparkSession, a: argparse.Namespace, ok: DataFrame, failed: DataFrame) -> None:
    """Rows of valid responses, and failed ones beside them, in a folder per set of results: a repeated run replaces its own."""
    if a.task == "seed":
        rows = validation.valid_seeds(ok)
    elif a.task == "question":
        rows = validation.question_rows(validation.valid_questions(ok))
    elif a.task == "answer":
        every = validation.answer_records(ok)
        failed = failed.unionByName(every.where("error IS NOT NULL").select(F.lit(None).cast("string").alias("custom_id"), F.col("question_idx").alias("row_idx"), "error", F.col("answer_text").alias("raw_text")))
        rows = every.where("error IS NULL").drop("error")
    else:
        rows = validation.claim_records(ok, a.model or "")
    run = f"results={sha256(a.results.encode()).hexdigest()[:16]}"
    jsonl.write_objects(rows, f"{a.out}/{run}")
    jsonl.write_objects(failed, f"{a.out}_failed/{run}")


def consume(spark: SparkSession, a: argparse.Namespace) -> None:
    """``--results`` are landed result lines, or with ``--from-jobs`` a job map whose completed jobs are consumed."""
    source, task = _read(spark, a.input), _PROMPTS[a.task][0]
    if a.from_jobs:
        ok, failed = jobs.consume(spark, _client(a), jobs.read_jobs(spark, a.results), source, task)
    else:
        ok, failed = tasks.joined(tasks.responses(jsonl.read_lines(spark, a.results), task), source)
    _consumed(spark, a, ok, failed)


def filter_by_model(spark: SparkSession, a: argparse.Namespace) -> None:
    """Passages that a yes/no model does not take for reference lists (stand-in: words that such lists hold)."""
    rows = chunking.model_filter(_read(spark, a.input), models.keyword_scorer("doi", "et al", "journal"), a.threshold)
    jsonl.write_objects(rows, a.out)


def build_pools(spark: SparkSession, a: argparse.Namespace) -> None:
    seeds = pools.usable(_read(spark, a.input)).withColumn("embed_text", retrieval.pool_embed_text(a.use_source))
    source = first_text(*(c for c in ("source_text", "text", "passage_text") if c in seeds.columns))
    seeds = models.hashing_encoder().with_vector(seeds.withColumn("source_text", source), "embed_text", "vector")
    seeds = write_table(seeds.withColumn("id", F.col("row_idx")).withColumn("guideline_id", group_of_passage("guideline_id", "passage_id")), "seeds")
    group = F.lit("ALL") if a.cross_guideline else F.col("guideline_id")
    members = pools.members(seeds.select(group.alias("group"), "id", "vector"), a.min_passages, a.max_passages, a.min_similarity)
    kept = pools.numbered(pools.without_near_duplicates(pools.pools(members), a.max_jaccard))
    fields = [c for c in ("passage_id", "guideline_id", "content_type", "main_topic", "semantic_summary", "question_angles", "patient_language_keywords", "source_text", "page_start", "page_end", "source_pdf") if c in seeds.columns]
    jsonl.write_objects(pools.records(kept, members, seeds.select("id", *fields)), f"{a.out}/pools", order="group_id")
    jsonl.write_document(pools.statistics(kept), f"{a.out}/statistics")


def build_index(spark: SparkSession, a: argparse.Namespace) -> None:
    jsonl.refuse_nonempty(spark, a.out, a.overwrite)
    rows = retrieval.index_rows(_read(spark, a.input), not a.all_passages)
    encoder = models.hashing_encoder()
    documents.write_index(encoder.with_vector(rows, "embedding_text"), a.out, a.overwrite)
    if a.smoke_query:
        asked = encoder.with_vector(spark.createDataFrame([(0, a.smoke_query)], "query_id long, text string"), "text", "vector")
        index = documents.read_index(spark, a.out)
        hits = vectors.search(index.select(F.col("row_idx").alias("id"), F.col("embedding").alias("vector")), asked, a.smoke_k)
        hits.join(index.select(F.col("row_idx").alias("id"), "passage_id", "main_topic"), "id").orderBy("rank").select("rank", "score", "passage_id", "main_topic").show(a.smoke_k, truncate=80)


def retrieve(spark: SparkSession, a: argparse.Namespace) -> None:
    index = documents.read_index(spark, a.index)
    asked = retrieval.with_question_ids(retrieval.rows_limited(_read(spark, a.input), a.start, a.limit))
    asked = retrieval.pending(asked.where(F.length(norm_ws("question")) > 0), jsonl.done_ids(spark, a.out))
    asked = asked.withColumn("search_text", retrieval.search_text(asked, a.recall_anchors)).withColumn("rerank_query", retrieval.rerank_query(asked, a.rerank_anchors))
    vectors_of = models.hashing_encoder().with_vector(asked, "search_text", "vector").select(F.col("question_id").alias("query_id"), "vector")
    hits = vectors.search(index.select(F.col("row_idx").alias("id"), F.col("embedding").alias("vector")), vectors_of, a.recall_k)
    named = hits.join(index.select(F.col("row_idx").alias("id"), "passage_id", retrieval.rerank_document(a.document_chars).alias("document")), "id")
    kept = retrieval.candidates(named).join(asked.select(F.col("question_id").alias("query_id"), "rerank_query"), "query_id")
    asked_of = kept.select("query_id", "passage_id", F.col("rank").cast("int").alias("faiss_rank"), F.col("score").alias("faiss_score"), "rerank_query", "document")
    scored = models.overlap_reranker().with_score(asked_of, "rerank_query", "document").drop("rerank_query", "document")
    found = retrieval.retrieved(retrieval.reranked(scored, a.out_k), index, a.output_chars)
    jsonl.write_objects(asked.drop("search_text", "rerank_query").join(found.withColumnRenamed("query_id", "question_id"), "question_id"), a.out, "append")


def evaluate(spark: SparkSession, a: argparse.Namespace) -> None:
    items = _read(spark, a.input).withColumn("item_id", F.col("row_idx"))
    if a.limit >= 0:
        items = items.where(F.col("row_idx") < a.limit)
    claims, model = evaluation.claims(items), models.containment_entailment()
    checked = write_table(evaluation.verified(claims, model).drop("premise", "cited"), "claims")
    if a.individual:
        jsonl.write_objects(evaluation.individually(claims, model), f"{a.out}_individual")
    per_item = evaluation.per_item(items, checked)
    jsonl.write_evaluation(checked, per_item, evaluation.summary(per_item), evaluation.augmented(items, checked) if a.augmented else None, a.out)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sparquill", description=__doc__)
    sub = top.add_subparsers(required=True)

    def command(name: str, run, *options: tuple[str, object]) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        p.set_defaults(run=run)
        p.add_argument("--input", required=True)
        p.add_argument("--out", required=True)
        for flag, default in options:
            if isinstance(default, bool):
                p.add_argument(f"--{flag}", action=argparse.BooleanOptionalAction, default=default)
            else:
                p.add_argument(f"--{flag}", type=type(default) if default is not None else str, default=default)
        return p

    command("passages", build_passages, ("pattern", "*.pdf"), ("min-words", 100), ("max-words", 220), ("overlap", 1), ("reference-threshold", 0.75), ("overwrite", False))
    command("filter", filter_by_model, ("threshold", 0.80))
    for name, run in (("requests", build_requests), ("run-split", run_split), ("consume", consume)):
        p = command(name, run, *([("single", False)] if run is build_requests else [("client", "")]), *([("from-jobs", False)] if run is consume else []))
        p.add_argument("--task", choices=sorted(_PROMPTS), required=True)
        p.add_argument("--model", required=run is not consume)
        if run is not consume:
            p.add_argument("--start", type=int, default=0)
            p.add_argument("--end", type=int, default=-1)
            p.add_argument("--chunk", type=int, default=0)
            p.add_argument("--max-output-tokens", type=int)
            p.add_argument("--temperature", type=float)
        else:
            p.add_argument("--results", required=True)
    command("submit", submit, ("client", ""), ("window", jobs.WINDOW))
    command("status", status, ("client", ""))
    command("pools", build_pools, ("min-passages", 15), ("max-passages", 30), ("min-similarity", 0.42), ("max-jaccard", 0.55), ("use-source", False), ("cross-guideline", False))
    command("index", build_index, ("all-passages", False), ("overwrite", False), ("smoke-query", ""), ("smoke-k", 5))
    p = command("retrieve", retrieve, ("recall-k", 50), ("out-k", 5), ("start", 0), ("limit", 0), ("document-chars", 2500), ("output-chars", 2000), ("recall-anchors", True), ("rerank-anchors", False))
    p.add_argument("--index", required=True)
    command("evaluate", evaluate, ("limit", -1), ("augmented", True), ("individual", False))
    return top


def main(args: list[str] | None = None) -> None:
    a = parser().parse_args(args)
    a.run(SparkSession.builder.appName("sparquill").getOrCreate(), a)


if __name__ == "__main__":
    main()
