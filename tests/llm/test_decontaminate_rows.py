"""The pipeline's decontamination decides by the row, and short items do not decide alone."""

import corpus_pipeline as P
from tests.llm.helpers import docs

LEAK = "one two three four five six seven eight nine"


def frame(spark, folder, items):
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{folder}/benchmark.parquet")


def left(spark, folder, rows):
    d = docs(spark, rows)
    out = P.decontaminate(spark, d, str(folder))
    assert out.columns == d.columns and out.schema.simpleString() == d.schema.simpleString()
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)


def test_null_and_shared_ids(spark, tmp_path):
    frame(spark, tmp_path, [(1, LEAK)])
    rows = [(None, f"x {LEAK}"), (None, "clean"), (5, LEAK), (5, "clean too"), (6, None), (7, "other"), (7, "other")]
    assert left(spark, tmp_path, rows) == sorted([(None, "clean"), (5, "clean too"), (6, None), (7, "other"), (7, "other")], key=str)


def test_short_items(spark, tmp_path):
    frame(spark, tmp_path, [(1, LEAK), (2, "the"), (3, "of it")])
    rows = [(1, "the whole text"), (2, f"a {LEAK}"), (3, "the end of it"), (4, "none")]
    assert left(spark, tmp_path, rows) == [(1, "the whole text"), (4, "none")]
