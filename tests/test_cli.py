"""The stages one after another through the command line."""

import json

from sparquill import cli


def read(path):
    return [json.loads(line) for p in sorted(path.rglob("*.json")) for line in p.read_text().splitlines()]


def answered(folder, requests, payload):
    """Result lines of a stand-in service: ``payload`` of each request."""
    folder.mkdir(exist_ok=True)
    lines = [json.loads(x) for p in sorted(requests.rglob("*.txt")) for x in p.read_text().splitlines()]
    (folder / "a.jsonl").write_text("\n".join(json.dumps({"custom_id": x["custom_id"], "response": {"body": {"output_text": json.dumps(payload(x))}}}) for x in lines))
    return lines


def test_one_stage_feeds_the_next(spark, tmp_path, capfd):
    """Passages to support rates, each stage on the output of the one before."""
    docs = tmp_path / "docs"
    docs.mkdir()
    for k in range(3):
        (docs / f"g{k}.txt").write_text(" ".join(f"Care topic{j % 5} of group{k} helps adults with pain number{j} every day now." for j in range(60)))
    t = str(tmp_path)
    cli.main(["passages", "--input", str(docs), "--out", f"{t}/p", "--pattern", "*.txt", "--min-words", "10", "--max-words", "40"])
    cli.main(["filter", "--input", f"{t}/p/passages", "--out", f"{t}/clean"])
    passages = read(tmp_path / "clean")
    assert len(passages) == len(read(tmp_path / "p" / "passages")) and passages[0]["qwen_reference_score"] < 0.8

    stage = lambda task, source, *more: cli.main(["requests", "--task", task, "--input", source, "--out", f"{t}/req_{task}", "--model", "m", *more])
    take = lambda task, source, *more: cli.main(["consume", "--task", task, "--input", source, "--results", f"{t}/res_{task}", "--out", f"{t}/{task}", *more])
    stage("seed", f"{t}/clean")
    seed = {"passage_id": "", "usable": True, "discard_reason": "", "content_type": "mixed", "main_topic": "pain care", "semantic_summary": "This passage describes pain care.", "question_angles": ["who"], "patient_language_keywords": ["pain"]}
    answered(tmp_path / "res_seed", tmp_path / "req_seed", lambda x: seed)
    take("seed", f"{t}/clean")
    take("seed", f"{t}/clean")  # a repeated run replaces its rows
    assert len(read(tmp_path / "seed")) == len(passages)

    cli.main(["pools", "--input", f"{t}/seed", "--out", f"{t}/pools", "--min-passages", "5", "--max-passages", "6", "--use-source"])
    pool = read(tmp_path / "pools" / "pools")[0]
    own = {p["passage_id"] for p in passages}
    assert pool["guideline_id"] in ("g0", "g1", "g2") and pool["anchor_passage_id"] in pool["passage_ids"] and set(pool["passage_ids"]) <= own
    assert [p["passage_id"] for p in pool["passages"]] == pool["passage_ids"] and pool["group_topic_hint"] == "pain care" and pool["passages"][0]["source_text"]
    assert {"avg_similarity_to_anchor", "min_similarity_to_anchor", "num_passages", "group_id"} <= set(pool)

    stage("question", f"{t}/pools/pools", "--single")
    question = {"pool_id": "", "guideline_id": "", "questions": [{"question": "How does care of topic3 help adults?", "question_type": "eligibility", "perspective": "patient_self", "patient_keywords": ["pain"], "retrieval_anchor_terms": ["topic3"]}], "skip_reason": ""}
    lines = answered(tmp_path / "res_question", tmp_path / "req_question", lambda x: question)
    assert f"guideline_id: {pool['guideline_id']}" in lines[0]["body"]["input"][1]["content"]
    take("question", f"{t}/pools/pools")
    cli.main(["index", "--input", f"{t}/seed", "--out", f"{t}/index", "--smoke-query", "care of topic3", "--smoke-k", "2"])
    assert "passage_id" in capfd.readouterr().out
    cli.main(["retrieve", "--input", f"{t}/question", "--index", f"{t}/index", "--out", f"{t}/found", "--recall-k", "10", "--out-k", "3"])

    stage("answer", f"{t}/found")
    answer = {"answer_text": "Care helps adults with pain. [1] It does so every day. [2]", "answer_sentences": [{"text": "Care helps adults with pain. [1]", "citations": [1], "role": "direct_answer"}, {"text": "It does so every day. [2]", "citations": [2], "role": "bogus"}], "evidence_gaps": []}
    lines = answered(tmp_path / "res_answer", tmp_path / "req_answer", lambda x: answer)
    prompt = lines[0]["body"]["input"][1]["content"]
    assert "\nsection: " in prompt and "\nrerank_score: 0." in prompt and 'retrieval_anchor_terms: ["topic3"]' in prompt
    take("answer", f"{t}/found")
    record = read(tmp_path / "answer")[0]
    assert record["question"].startswith("How does") and record["patient_keywords"] == ["pain"] and record["answer"] == record["answer_text"]
    assert [p["pid"] for p in record["passages"]] == [1, 2, 3] and [p["passage_id"] for p in record["top_passages"]] == [p["passage_id"] for p in record["passages"]]

    stage("claims", f"{t}/answer")
    claims = {"sentences": [{"sentence_id": 1, "claims": ["care helps adults with pain"]}, {"sentence_id": 2, "claims": ["zebras fly", "it is every day"]}]}
    lines = answered(tmp_path / "res_claims", tmp_path / "req_claims", lambda x: claims)
    assert "SENTENCE 1\nTEXT: Care helps adults with pain." in lines[0]["body"]["input"][1]["content"]
    take("claims", f"{t}/answer", "--model", "m")
    record = read(tmp_path / "claims")[0]
    assert (record["num_sentences_detected"], record["num_atomic_facts"], record["atomic_model"], record["atomic_error"]) == (2, 3, "m", "")
    assert [len(s["atomic_facts"]) for s in record["sentence_atomic_decomposition"]] == [1, 2] and record["atomic_facts_flat"][2]["atomic_fact_id"] == "s2_a2"
    assert record["atomic_facts_flat"][0]["cited_passages"][0]["pid"] == 1

    cli.main(["evaluate", "--input", f"{t}/claims", "--out", f"{t}/eval", "--individual"])
    n = len(read(tmp_path / "claims"))
    summary = read(tmp_path / "eval_summary")[0]
    assert summary["num_items"] == n and summary["num_claims_evaluated"] == 3 * n and 0 < summary["micro_rate"] < 1
    assert len(read(tmp_path / "eval_individual")) == 3 * n


def test_job_commands(spark, tmp_path):
    t = FOLDER[0] = str(tmp_path)
    (tmp_path / "in.jsonl").write_text("\n".join(json.dumps({"passage_id": f"p{k}", "text": f"text {k}", "guideline_id": "g", "source_pdf": "a", "section_title": "", "page_start": 1, "page_end": 1, "word_count": 2, "reference_list_score": 0.0}) for k in range(5)))
    cli.main(["run-split", "--task", "seed", "--input", f"{t}/in.jsonl", "--out", f"{t}/req", "--model", "m", "--chunk", "2"])
    names = [p.name for p in sorted((tmp_path / "req").iterdir()) if p.name.startswith("name=")]
    assert [n for n in names if not n.endswith(".meta")] == ["name=000000_000002", "name=000002_000004", "name=000004_000006"]
    assert read(tmp_path / "req" / "name=000000_000002.meta")[0]["batch_id"] == "batch_0001"
    cli.main(["submit", "--input", f"{t}/req/name=000000_000002", "--out", f"{t}/one"])
    cli.main(["status", "--input", f"{t}/req.batches", "--out", f"{t}/now"])
    jobs_now = [line.split("\t") for p in sorted((tmp_path / "now").glob("*.txt")) for line in p.read_text().splitlines()]
    assert len(jobs_now) == 3 and {j[3] for j in jobs_now} == {"completed"}
    for n in names:
        if not n.endswith(".meta"):
            answered(tmp_path / "req" / f"{n}_out", tmp_path / "req" / n, lambda x: {"passage_id": "", "usable": False, "discard_reason": "", "content_type": "mixed", "main_topic": "", "semantic_summary": "", "question_angles": [], "patient_language_keywords": []})
    cli.main(["consume", "--task", "seed", "--input", f"{t}/in.jsonl", "--results", f"{t}/req.batches", "--from-jobs", "--client", "tests.test_cli:landed", "--out", f"{t}/seeds"])
    assert sorted(r["passage_id"] for r in read(tmp_path / "seeds")) == [f"p{k}" for k in range(5)]


def landed():
    """A service whose batches are the three request folders in order, with results beside them."""

    class Client:
        def status(self, batch_id):
            k = int(batch_id[-4:]) - 1
            return {"batch_id": batch_id, "status": "completed", "output": FOLDER[0] + f"/req/name={2 * k:06d}_{2 * k + 2:06d}_out"}

    return Client()


FOLDER = [""]


def test_stages(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    for k in range(3):
        (docs / f"g{k}.txt").write_text(" ".join(f"Care topic{j % 5} of group{k} helps adults with pain number{j} every day now." for j in range(60)))
    t = str(tmp_path)
    cli.main(["passages", "--input", str(docs), "--out", f"{t}/p", "--pattern", "*.txt", "--min-words", "10", "--max-words", "40"])
    passages = read(tmp_path / "p" / "passages")
    assert len(passages) > 20 and read(tmp_path / "p" / "summary")[0]["num_documents"] == 3

    cli.main(["requests", "--task", "seed", "--input", f"{t}/p/passages", "--out", f"{t}/req", "--model", "m", "--chunk", "10"])
    lines = [json.loads(x) for p in sorted((tmp_path / "req").glob("name=*/*.txt")) for x in p.read_text().splitlines()]
    assert len(lines) == len(passages) and lines[0]["body"]["text"]["format"]["name"] == "seed"
    results = tmp_path / "results"
    results.mkdir()
    answer = lambda k: json.dumps({"passage_id": "", "usable": True, "discard_reason": "", "content_type": "mixed", "main_topic": "pain care", "semantic_summary": "This passage describes pain care.", "question_angles": ["who"], "patient_language_keywords": ["pain"]})
    (results / "a.jsonl").write_text("\n".join(json.dumps({"custom_id": x["custom_id"], "response": {"body": {"output_text": answer(x)}}}) for x in lines))
    cli.main(["consume", "--task", "seed", "--input", f"{t}/p/passages", "--results", str(results), "--out", f"{t}/seeds"])
    assert len(read(tmp_path / "seeds")) == len(passages)

    cli.main(["pools", "--input", f"{t}/seeds", "--out", f"{t}/pools", "--min-passages", "3", "--max-passages", "6", "--use-source"])
    found = read(tmp_path / "pools" / "pools")
    assert found and found[0]["group_id"] == "grp_000001" and len(found[0]["passages"]) >= 3

    cli.main(["index", "--input", f"{t}/seeds", "--out", f"{t}/index"])
    (tmp_path / "q.jsonl").write_text(json.dumps({"question": "How does care of topic3 help adults?", "retrieval_anchor_terms": ["topic3"]}) + "\n" + json.dumps({"question": " "}) + "\n")
    args = ["retrieve", "--input", f"{t}/q.jsonl", "--index", f"{t}/index", "--out", f"{t}/found", "--recall-k", "10", "--out-k", "3"]
    cli.main(args)
    cli.main(args)  # nothing is pending now
    rows = read(tmp_path / "found")
    assert len(rows) == 1 and [p["rank"] for p in rows[0]["retrieved_passages"]] == [1, 2, 3]

    p = {"pid": 1, "passage_id": "p", "guideline_id": "g", "main_topic": "m", "section": "s", "text": "aspirin helps pain"}
    fact = {"atomic_fact_id": "s1_a1", "fact": "aspirin helps", "source_sentence_id": 1, "source_sentence_role": "direct_answer", "citation_ids": [1], "cited_passages": [p]}
    (tmp_path / "items.jsonl").write_text(json.dumps({"question_type": "other", "atomic_facts_flat": [fact], "passages": [p]}) + "\n")
    cli.main(["evaluate", "--input", f"{t}/items.jsonl", "--out", f"{t}/eval"])
    assert read(tmp_path / "eval_summary")[0]["micro_rate"] == 1.0
