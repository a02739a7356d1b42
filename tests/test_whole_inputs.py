"""Derived inputs hold whole texts: what stands at the very end of a long one reaches the operators."""

import hashlib

from sparquill.plans import registry

Q = registry.queries()


def table(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_pages_hold_whole_texts(spark, tmp_path):
    said = [f"w{k} is one of the many words of a long text here." for k in range(2000)]
    table(spark, tmp_path, "documents", [(2, " ".join(said), "s")], "doc_id long, text string, source string")
    units = Q["unit_sections"](spark, str(tmp_path)).collect()
    assert sum(r.words for r in units) >= 2000 * 12
    assert max(r.para for r in units if r.page == 3) > 1900
    last = max(Q["chunked_passages"](spark, str(tmp_path)).collect(), key=lambda r: r.passage_id)
    assert last.text in {md5(" ".join(said[-n:])) for n in range(1, 40)}


def test_reference_zone_runs_to_the_end(spark, tmp_path):
    text = "x" * 7500 + ". Then more. References. One work. Two works."
    table(spark, tmp_path, "documents", [(2, text, "s")], "doc_id long, text string, source string")
    assert Q["chunk_counts"](spark, str(tmp_path)).first().removed_by_ref_heading_zone == 3


def test_index_holds_whole_texts_and_grows(spark, tmp_path):
    text = " ".join(f"word{k}" for k in range(200))
    table(spark, tmp_path, "documents", [(k, text, "s") for k in range(3000)], "doc_id long, text string, source string")
    rows = Q["index_rows"](spark, str(tmp_path)).collect()
    blank = sum(k % 11 == 0 for k in range(3000))
    named = [r for r in rows if not r.passage_id.startswith("passage_")]
    assert {r.text for r in rows} == {md5(text)}
    assert len(rows) - len(named) <= blank and 1200 < len(named) <= 1500  # a pair of neighbours shares an id


def test_items_grow_with_the_table(spark, tmp_path):
    table(spark, tmp_path, "documents", [(k,) for k in range(2400)], "doc_id long")
    table(spark, tmp_path, "labels", [(k, 1) for k in range(0, 2400, 3)], "doc_id long, quality int")
    rows = Q["item_rates"](spark, str(tmp_path)).collect()
    assert len(rows) == 600 and sum(r.num_raw for r in rows) == 2400
    assert sorted(r.item_id for r in rows if r.num_raw == 0) == list(range(5, 600, 6))
    totals = Q["data_set_rates"](spark, str(tmp_path)).first()
    assert (totals.num_items, totals.num_claims_raw, totals.num_claims_supported) == (600, 2400, 800)


def test_answers_hold_whole_turns(spark, tmp_path):
    turn = " ".join(f"word{k}" for k in range(300))
    table(spark, tmp_path, "conversations", [(2, 0, "assistant", turn)], "conv_id long, turn long, role string, text string")
    n = len(turn) // 3
    second = "B " + turn[n:] + " [0] x [4]."  # the mark of conversation 2; its last citation stays visible
    facts = Q["atomic_facts"](spark, str(tmp_path)).collect()
    assert md5("A " + turn[:n] + ".") in {r.sentence for r in facts}
    assert md5(second) in {r.sentence for r in facts}
    answer = f"A {turn[:n]}. [1] B {turn[n : 2 * n]}! [2][3] C {turn[2 * n :]}"
    assert Q["valid_answers"](spark, str(tmp_path)).first().answer_text == md5(" ".join(answer.split()))


def test_prompts_and_headings_read_whole_texts(spark, tmp_path):
    text = "q" * 200 + " " * 400 + "found after five hundred characters. More of it. Methods"
    table(spark, tmp_path, "documents", [(6, text)], "doc_id long, text string")
    assert Q["request_lines"](spark, str(tmp_path)).count() == 1
    rows = Q["headings"](spark, str(tmp_path)).collect()
    assert len(rows) == 3 and sum(r.is_section for r in rows) == 1
