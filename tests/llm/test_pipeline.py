"""Each stage of the corpus pipeline, on its own input, against a plain reading of its rule."""

from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from sparquill.llm import pii, quality
from sparquill.llm.decontam import words_of
from sparquill.llm.tokens import tokenizer
from tests.conftest import SMALL
from tests.llm.helpers import documents
from tests.llm.test_simhash import components, naive


def test_stages(spark):
    docs = documents(spark, SMALL)
    start = {r.doc_id: r.text for r in docs.collect()}

    one = P.quality(spark, docs, SMALL)
    assert one.columns == docs.columns
    kept = {r.doc_id: r.text for r in one.collect()}
    model = quality.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    tails = quality._scores(model, 1)(list(start.values()))[1]
    assert set(kept) == {d for (d, t), p in zip(start.items(), tails, strict=True) if p >= 0.5 and t and t.strip()}

    two = P.near_dedup(spark, one, SMALL)
    own = sorted((d, naive(t)) for d, t in kept.items())
    assert two.columns == docs.columns
    assert {r.doc_id for r in two.collect()} == {d for (d, _), c in zip(own, components(own), strict=True) if c == d}

    three = P.decontaminate(spark, two, SMALL)
    windows = set()
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        w = words_of(r.text)
        windows |= {tuple(w[k : k + 8]) for k in range(max(1, len(w) - 7))} if w else set()
    clean = {r.doc_id for r in two.collect() if not any(tuple(w[k : k + n]) in windows for w in [words_of(r.text)] for n in {len(x) for x in windows} for k in range(len(w) - n + 1))}
    assert {r.doc_id for r in three.collect()} == clean

    four = P.pii(spark, three, SMALL)
    texts = {r.doc_id: r.text for r in four.collect()}
    assert texts == {r.doc_id: pii.redact(r.text, pii.trained()) for r in three.collect()}

    enc = tokenizer().tokenizer
    found = {}
    for r in P.packing(spark, four, SMALL).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert set(found) == set(texts)
    for d, rows in found.items():
        ids = np.array([*enc.encode(texts[d], add_special_tokens=False).ids, 1], "<u4")
        assert sum(r.length for r in rows) == len(ids)
        assert all(r.ids_crc32 == crc32(ids[r.start : r.start + r.length].tobytes()) for r in rows)


def test_repeated_rows_and_nulls(spark):
    docs = documents(spark, SMALL).limit(3)
    twice = docs.union(docs).union(docs.selectExpr("CAST(NULL AS LONG) AS doc_id", "CAST(NULL AS STRING) AS text", "lang", "source", "n_chars").limit(1))
    assert P.near_dedup(spark, twice, SMALL).count() <= 4
    assert P.decontaminate(spark, twice, SMALL).columns == docs.columns
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0


def test_near_dedup_of_repeated_ids(spark):
    """Null ids, rows equal but for other columns, ids that repeat with other texts, columns with clashing names."""
    far = [" ".join(f"{w}{k}" for k in range(60)) for w in ("red", "blue", "green")]
    rows = [(1, far[0], 9), (1, far[0], 4), (1, far[1], 7), (2, far[0], 1), (3, far[2], 5), (3, far[2], 5), (4, far[1], 2), (None, far[2], 3), (None, None, 8), (5, None, 1), (6, "", 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, fp int").withColumn("component_id", F.lit("x")).withColumn("keep", F.array(F.lit(1)))
    out = P.near_dedup(spark, d, SMALL)
    assert out.columns == d.columns and out.schema.simpleString() == d.schema.simpleString()
    got = sorted(((r.doc_id, r.text, r.fp) for r in out.collect()), key=str)
    assert got == sorted([(1, far[0], 4), (1, far[1], 7), (3, far[2], 5), (None, far[2], 3), (None, None, 8), (5, None, 1)], key=str)


def test_clashing_columns_and_long_texts(spark):
    """Every stage but the last keeps the columns it was given, whatever their names; an unbroken and a long text pass."""
    d = documents(spark, SMALL).limit(20).select("*", F.lit("x").alias("items"), F.lit(1).alias("row"), F.lit(2).alias("block"), F.lit("y").alias("hits"), F.lit(0.5).alias("score"))
    long = spark.createDataFrame([(10**6, "q7" * 60_000, "en", "s", 1, "x", 1, 2, "y", 0.5), (10**6 + 1, "some words here " * 30_000, "en", "s", 1, "x", 1, 2, "y", 0.5)], d.schema)
    d = d.unionByName(long)
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, d, SMALL).columns == d.columns, name
        stage(spark, d, SMALL).write.format("noop").mode("overwrite").save()
    packed = P.packing(spark, d, SMALL)
    assert packed.where("doc_id = 1000001").selectExpr("sum(length)").first()[0] == packed.where("doc_id = 1000001").first().doc_tokens


def test_run(spark):
    rows = P.run(spark, SMALL).collect()
    assert rows and [n for n, _ in P.STAGES] == ["quality", "near_dedup", "decontaminate", "pii", "packing"]
