"""Chunking, pools, retrieval, jobs, models, sources and streaming on small inputs."""

import json

import pytest
from pyspark.sql import functions as F

from sparquill.operators import chunking, evaluation, jobs, models, pools, retrieval, tasks, validation, vectors
from sparquill.sources import documents, jsonl
from sparquill.streaming import consume


def chunk(spark, pages, **kw):
    docs = spark.createDataFrame([("g", "g.pdf", pages)], "guideline_id string, source_pdf string, pages array<string>")
    rows, counts = chunking.passages(docs, **kw)
    return rows.orderBy("passage_id").collect(), counts.first()


def sentence(n, mark="w"):
    return " ".join(f"{mark}{k}" for k in range(n - 1)) + " end."


def test_flush_trigger_and_overlap_chunk(spark):
    rows, _ = chunk(spark, [f"{sentence(6)} {sentence(4)} Methods? {sentence(8, 'z')}"], min_words=1, max_words=10)
    assert [r.word_count for r in rows] == [10, 4, 8]  # the overlap alone is a chunk before the heading
    assert [r.section_title for r in rows] == ["", "", "Methods?"]
    assert [r.passage_id for r in rows] == ["g_p00001", "g_p00002", "g_p00003"]


def test_tail_merge_bounds(spark):
    exact, _ = chunk(spark, [f"{sentence(20)} {sentence(60)}"], min_words=100, max_words=20, overlap_sentences=0)
    assert [r.word_count for r in exact] == [80]
    over, _ = chunk(spark, [f"{sentence(60)} {sentence(41)}"], min_words=100, max_words=20, overlap_sentences=0)
    assert [r.word_count for r in over] == [60, 41]


def test_reference_section_is_sticky(spark):
    rows, counts = chunk(spark, [f"{sentence(5)} References are listed below. {sentence(5)}", sentence(9)], min_words=1, max_words=100)
    assert [r.word_count for r in rows] == [5]
    assert counts.removed_by_ref_heading_zone == 3


def test_empty_documents(spark):
    docs = spark.createDataFrame([("g", None, None)], "guideline_id string, source_pdf string, pages array<string>")
    rows, counts = chunking.passages(docs)
    assert rows.count() == 0
    assert counts.first().num_kept_chunks_after_tail_merge == 0


def vecs(spark, rows):
    return spark.createDataFrame(rows, "group string, id long, vector array<double>")


def test_pools(spark):
    rows = vecs(spark, [("a", 1, [1.0, 0.0]), ("a", 2, [0.9, 0.1]), ("a", 3, [0.0, 1.0]), ("b", 4, [1.0, 0.0])])
    got = {(r.anchor): r for r in pools.pools(pools.members(rows, 1, 2, 0.5)).collect()}
    assert got[4].num_passages == 1 and got[4].avg_similarity == 1.0
    assert got[1].passage_ids == [1, 2]
    assert 4 not in {r.anchor for r in pools.pools(pools.members(rows, 2, 2, 0.5)).collect()}


def test_anchor_stays_below_the_threshold(spark):
    rows = vecs(spark, [("a", 1, [0.1, 0.0]), ("a", 2, [1.0, 0.0])])
    got = {r.anchor: r.passage_ids for r in pools.pools(pools.members(rows, 1, 2, 0.5)).collect()}
    assert got[1] == [1]


def test_greedy_equals_going_through(spark):
    import random

    r = random.Random(4)
    rows = [("g", k, 5, float(r.randint(0, 20)), 0.0, sorted(r.sample(range(14), 4))) for k in range(40)]
    df = spark.createDataFrame(rows, "group string, anchor long, num_passages long, avg_similarity double, min_similarity double, passage_ids array<long>")
    kept = []
    for row in sorted(rows, key=lambda x: (-x[3], -x[2], x[0], x[1])):
        s = set(row[5])
        if all(len(s & set(k[5])) / len(s | set(k[5])) < 0.3 for k in kept):
            kept.append(row)
    got = {x.anchor for x in pools.without_near_duplicates(df, 0.3).collect()}
    assert got == {k[1] for k in kept}
    assert pools.without_near_duplicates(df, 0.0).count() == 1


def test_counts_move_no_passages(spark):
    docs = spark.createDataFrame([("g", "s", ["One. Two three. " * 40])], "guideline_id string, source_pdf string, pages array<string>")
    rows, counts = chunking.passages(docs, 4, 9)
    assert counts.first().num_kept_chunks_after_tail_merge == rows.count() > 0
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "final" not in plan


def test_search_beyond_the_corpus(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None)], "id long, vector array<double>")
    asked = spark.createDataFrame([("q", [0.5, 0.5])], "query_id string, vector array<double>")
    got = vectors.search(corpus, asked, 9).orderBy("rank").collect()
    assert [(r.id, r.score) for r in got] == [(1, 0.5), (2, 0.5)]
    many = spark.range(7).select("id", F.array(F.col("id") * 1.0).alias("vector"))
    both = vectors.search(many, many.select(F.col("id").alias("query_id"), "vector"), 2, chunk=3)
    assert both.count() == 14


def test_blocks_of_a_group_agree(spark):
    rows = spark.range(50).select(F.lit("g").alias("group"), "id", F.array(F.sin(F.col("id").cast("double")), F.cos(F.col("id").cast("double"))).alias("vector"))
    whole, cut = (sorted(vectors.neighbours_in_group(rows, 4, block=b).select("anchor", "rank", "id").collect()) for b in (2048, 7))
    assert whole == cut


def test_index_hides_duplicates(spark):
    rows = spark.createDataFrame([(0, "p", ""), (1, "p", "text"), (2, "q", "BP")], "row_idx long, passage_id string, text string")
    assert [r.passage_id for r in retrieval.index_rows(rows).collect()] == ["q"]


def test_jobs_round_trip(spark, tmp_path):
    src = spark.createDataFrame([(k, f"q{k}", f"question {k}", [("p", "g", "m", "text")]) for k in range(5)], "row_idx long, question_id string, question string, retrieved_passages array<struct<passage_id:string,guideline_id:string,main_topic:string,text:string>>")
    reqs = tasks.requests(src, tasks.ANSWER, tasks.answer_prompt(), "m")
    client = jobs.LocalClient()
    made = jobs.run_split(spark, client, reqs, str(tmp_path / "req"), 2)
    assert len(made) == 3
    with pytest.raises(ValueError):
        jobs.submit(spark, client, made[0].jsonl, "1h")
    jobs.write_job_map(jobs.job_table(spark, made), str(tmp_path / "map"))
    assert jsonl.read_job_map(spark, str(tmp_path / "map")).count() == 3
    out = tmp_path / "out"
    out.mkdir()
    payload = json.dumps({"answer_text": "It is. [1]", "answer_sentences": [{"text": "It is. [1]", "citations": [1], "role": "direct_answer"}], "evidence_gaps": []})
    lines = [json.dumps({"custom_id": f"answer-{k}", "response": {"body": {"output_text": payload}}}) for k in (0, 3, 77)] + ["{broken", json.dumps({"custom_id": "answer-x", "response": None})]
    (out / "part.jsonl").write_text("\n".join(lines))
    client.results = {j.batch_id: str(out) for j in made[:1]} | {j.batch_id: None for j in made[1:]}
    ok, failed = jobs.consume(spark, client, jobs.refreshed(made, client), src, tasks.ANSWER)
    assert sorted(r.row_idx for r in ok.collect()) == [0, 3]
    assert sorted(r.error for r in failed.collect()) == ["bad custom_id", "line is not JSON", "row out of range"]
    answers = validation.valid_answers(ok, F.size("source.retrieved_passages")).collect()
    assert all(a.error is None and a.answer_sentences[0].citations == [1] for a in answers)


def test_stream_consumes_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    src = spark.createDataFrame([(0, "a"), (1, "b")], "row_idx long, question string")
    line = lambda k: json.dumps({"custom_id": f"atomic-{k}", "response": {"body": {"output_text": '{"sentences":[]}'}}})
    args = (spark, str(folder), tasks.CLAIMS, src, str(tmp_path / "ok"), str(tmp_path / "bad"), str(tmp_path / "cp"))
    (folder / "a.jsonl").write_text(line(0) + "\n")
    consume.consume_stream(*args).awaitTermination()
    (folder / "b.jsonl").write_text(line(1) + "\n" + line(9) + "\n")
    consume.consume_stream(*args).awaitTermination()
    assert sorted(r.row_idx for r in spark.read.json(str(tmp_path / "ok")).collect()) == [0, 1]
    assert spark.read.json(str(tmp_path / "bad")).count() == 1


def test_sources(spark, tmp_path):
    f = tmp_path / "a.jsonl"
    f.write_text('{"question_id":" q1 "}\n\n[1]\n{bad\n{"question_id":"q2"}\n')
    good, bad = jsonl.checked_objects(spark, str(f), "question_id string")
    assert good.count() == 2 and [r.line_no for r in bad.collect()] == [4]
    assert sorted(r.question_id for r in jsonl.done_ids(spark, str(f)).collect()) == ["q1", "q2"]
    assert jsonl.done_ids(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception):
        jsonl.read_objects(spark, str(f), "question_id string").count()
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "x.txt").write_bytes(b"page one\fpage-\ntwo")
    pages = documents.read_pages(spark, str(tmp_path / "docs"), "*.txt", documents.text_pages).first()
    assert pages.guideline_id == "x" and pages.pages == ["page one", "pagetwo"]
    broken = documents.read_pages(spark, str(tmp_path / "docs"), "*.txt", lambda b: 1 / 0).first()
    assert "ZeroDivisionError" in broken.error and broken.pages is None
    documents.write_index(spark.createDataFrame([(1, [0.5])], "row_idx long, embedding array<float>"), str(tmp_path / "ix"))
    assert documents.read_index(spark, str(tmp_path / "ix")).count() == 1
    with pytest.raises(FileExistsError):
        jsonl.refuse_nonempty(spark, str(tmp_path / "ix"))


def test_row_idx_is_gapless(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text("".join(f'{{"a":{k}}}\n' for k in range(57)))
    rows = jsonl.with_row_idx(jsonl.read_objects(spark, str(tmp_path / "t.jsonl"), "a long")).collect()
    assert all(r.a == r.row_idx for r in rows) and len(rows) == 57
    ordered = jsonl.with_row_idx(spark.range(40).repartition(5).select((39 - F.col("id")).alias("z")), "z").collect()
    assert all(r.z == r.row_idx for r in ordered)


def test_models_and_verdicts(spark):
    rows = spark.createDataFrame([("a b",), ("",), (None,)], "t string")
    got = models.hashing_encoder(8).with_vector(rows, "t").collect()
    assert all(len(r.embedding) == 8 for r in got)
    scored = chunking.model_filter(spark.createDataFrame([("see doi doi doi doi",), ("plain",)], "text string"), models.keyword_scorer("doi"))
    assert [r.text for r in scored.collect()] == ["plain"]
    facts = "array<struct<atomic_fact_id:string,fact:string,source_sentence_id:int,source_sentence_role:string,citation_ids:array<int>,cited_passages:array<struct<pid:int,passage_id:string,guideline_id:string,main_topic:string,section:string,text:string>>>>"
    passages = "array<struct<pid:int,passage_id:string,guideline_id:string,main_topic:string,section:string,text:string>>"
    p = (1, "p1", "g", "m", "s", "aspirin helps pain")
    items = spark.createDataFrame(
        [(1, "other", [("s1_a1", "aspirin helps", 1, None, [1], []), ("s1_a2", " ", 1, "r", [1], []), ("s1_a3", "unrelated words", 1, "r", [1, 8], [p]), ("s1_a4", "x", 1, "r", [7], [])], [p]), (2, "other", [], [p])],
        f"item_id long, question_type string, atomic_facts_flat {facts}, passages {passages}",
    )
    checked = evaluation.verified(evaluation.claims(items), models.containment_entailment())
    got = {r.atomic_fact_id: (r.filter_reason, r.joint_entailment) for r in checked.collect()}
    assert got == {"s1_a1": ("kept", 1), "s1_a2": ("empty_claim", None), "s1_a3": ("kept", 0), "s1_a4": ("no_cited_passage", None)}
    per_item = {r.item_id: r for r in evaluation.per_item(items, checked).collect()}
    assert per_item[1].support_rate == 0.5 and per_item[2].support_rate is None
    assert evaluation.individually(evaluation.claims(items), models.containment_entailment()).count() == 2
    assert evaluation.augmented(items, checked).count() == 2
    assert evaluation.summary(evaluation.per_item(items, checked)).first().num_items_without_evaluated == 1


def test_one_keyword_or_several(spark):
    rows = spark.createDataFrame([(0, "p", "text", " BP "), (1, "q", "text", None)], "row_idx long, passage_id string, text string, keywords string")
    got = {r.passage_id: r.embedding_text for r in retrieval.index_rows(rows).collect()}
    assert "Patient keywords: BP" in got["p"] and "Patient keywords" not in got["q"]


@pytest.mark.parametrize("least", [0.2, 0.5, 0.55, 1.0])
def test_conflicts_against_all_pairs(spark, least):
    import random

    r = random.Random(3)
    sets = [[0, *r.sample(range(1, 9), r.randint(1, 6))] for _ in range(60)] + [[0], [0], [1, 1, 2]]  # passage 0 is in nearly all
    rows = spark.createDataFrame(list(enumerate(sets)), "key int, passage_ids array<int>")
    jaccard = lambda x, y: len({*x} & {*y}) / len({*x} | {*y})
    want = {(a, b) for b in range(len(sets)) for a in range(b) if jaccard(sets[a], sets[b]) >= least}
    assert {(x.a, x.b) for x in pools.conflicts(rows, least).collect()} == want


def test_search_holds_the_same_memory_for_many_queries():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from sparquill.operators.vectors import _searcher

    dice = np.random.default_rng(3)
    q, x = dice.normal(size=(4096, 8)), dice.normal(size=(6000, 8))
    x[[5, 4000, 5999]] = x[17]  # equal vectors: by id, wherever they stand
    ids = dice.permutation(6000)
    batches = [pa.RecordBatch.from_arrays([pa.array(ids[at : at + 2500]), pa.array(list(x[at : at + 2500]))], names=["id", "vector"]) for at in range(0, 6000, 2500)]
    tracemalloc.start()
    found = pa.Table.from_batches(_searcher(None, q, 5)(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6
    got = {}
    for row, name, score in zip(*(found.column(c).to_pylist() for c in ("q", "id", "score")), strict=True):
        got.setdefault(row, []).append((-score, name))
    for row in range(0, 4096, 97):
        scores = (q[row] * x).sum(axis=1)
        assert sorted(got[row]) == sorted(zip((-scores).tolist(), ids.tolist(), strict=True))[:5]
    few = pa.Table.from_batches(_searcher(None, q[:2], 9)(iter([batches[0].slice(0, 4)])))
    assert few.num_rows == 8
