"""Neighbours against plain cosine over whole texts, held-out accuracy and calibration, edges."""

import random
import time
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from sparquill.llm import toxicity as t
from tests.conftest import SMALL
from tests.llm.helpers import docs, documents

EDGES = [(1, None), (2, ""), (3, "word " * 20_000), (4, "same"), (4, "same"), (5, "x" * 50_000), (6, "12 34 !?"), (None, "no id")]


def labels(spark, folder):
    return spark.read.parquet(f"{folder}/labels.parquet")


def bag_of(text):
    return Counter(k for w in t.words_of(text) for k in t.terms_of(w))


@pytest.mark.parametrize("piece", [1 << 20, 40])
def test_bags_count_all_terms(monkeypatch, piece):
    monkeypatch.setattr(t, "PIECE", piece)
    texts = ["Abcdefgh abcdefgh, ABC", None, "", "été wort worthless " * 30, "1 2 3"]
    text, term, count = t.Bags()(texts)
    for k, own in enumerate(texts):
        assert dict(zip(term[text == k].tolist(), count[text == k].tolist(), strict=True)) == bag_of(own)


@pytest.mark.parametrize("words", [1 << 18, 7])
def test_bags_hash_words_of_every_length(monkeypatch, words):
    monkeypatch.setattr(t, "WORDS", words)
    texts = ["", *("z" * n + " " + "é" * n + "-" + "ab" * n for n in range(1, 40)), *("Straße ΟΔΟΣ İx" for _ in range(300)), None, "\ud800 a"]
    text, term, count = t.Bags()(texts)
    for k, own in enumerate(texts):
        assert dict(zip(term[text == k].tolist(), count[text == k].tolist(), strict=True)) == bag_of(own)


def test_words_are_hashed_side_by_side():
    r = random.Random(4)
    texts = [" ".join("".join(r.choices("abcdefghij", k=r.randint(3, 12))) for _ in range(400)) for _ in range(256)]
    start = time.process_time()
    for own in texts:
        bag_of(own)
    plain = time.process_time() - start
    t.Bags()(texts)
    assert 3 * (time.process_time() - start - plain) < plain


def cosines(texts, examples, weight):
    """Plain cosine of every text with every example."""

    def vector(text):
        v = {k: (1 + np.log(n)) * weight[k] for k, n in bag_of(text).items()}
        norm = np.sqrt(sum(x * x for x in v.values()))
        return {k: x / norm for k, x in v.items()} if norm else v

    vectors = [vector(e) for e in examples]
    return np.array([[sum(x * e.get(k, 0.0) for k, x in q.items()) for e in vectors] for q in map(vector, texts)])


@pytest.mark.parametrize(("dense", "block"), [(8, 16), (1024, 64), (0, 64)])
def test_nearest_are_exact(monkeypatch, dense, block):
    monkeypatch.setattr(t, "DENSE", dense)
    monkeypatch.setattr(t, "BLOCK", block)
    r = random.Random(1)
    word = lambda: "".join(r.choice("abc") for _ in range(r.randint(2, 6)))
    make = lambda: " ".join(word() for _ in range(r.randint(0, 25)))
    examples, asked = [make() for _ in range(300)], [*(make() for _ in range(60)), "zzz", ""]
    weight = np.random.default_rng(2).uniform(0.2, 3, t.TERMS)
    index = t.BlockMaxIndex(t.Bags()(examples), np.zeros(300, bool), np.arange(300) + 5, weight)
    position, cosine, scored = index.nearest(t.Bags()(asked), len(asked), 11)
    every = cosines(asked, examples, weight)
    assert scored < len(asked) * index.n_blocks  # some blocks are left out
    for k, row in enumerate(every):
        best = np.sort(row)[::-1][:11]
        own = position[k] >= 0
        assert np.allclose(cosine[k][own], best[best > 1e-12]) and np.allclose(row[index.ids[position[k][own]] - 5], cosine[k][own])


def test_cosines_are_double_and_the_same_in_any_batch():
    r = random.Random(5)
    make = lambda: " ".join("".join(r.choices("abcd", k=r.randint(2, 6))) for _ in range(r.randint(1, 60)))
    examples, asked = [make() for _ in range(200)] + ["one two three"] * 100, [*(make() for _ in range(40)), "two three", "one two three"]
    weight = np.random.default_rng(6).uniform(0.2, 3, t.TERMS)
    index = t.BlockMaxIndex(t.Bags()(examples), np.zeros(300, bool), np.arange(300), weight)
    position, cosine, _ = index.nearest(t.Bags()(asked), len(asked), 16)
    for k, row in enumerate(cosines(asked, examples, weight)):
        own = position[k] >= 0
        assert np.allclose(cosine[k][own], np.sort(row[row > 0])[::-1][:16], rtol=1e-12, atol=0)
        alone = index.nearest(t.Bags()([asked[k]]), 1, 16)
        assert (alone[0][0] == position[k]).all() and (alone[1][0] == cosine[k]).all()
    assert (np.diff(position[-1]) == 1).all() and len(set(cosine[-1])) == 1  # equal examples tie, in order of position


@pytest.fixture(scope="module")
def held(spark):
    folder = SMALL.replace("sf0.001", "sf0.1")  # the smaller tables hold out six toxic rows
    d, known = documents(spark, folder), labels(spark, folder)
    return t.scored(d, t.train(d, known)).join(known.where("toxic IS NOT NULL"), "doc_id").where("held_out").collect()


def test_held_out_rows_and_calibration(held):
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for r in held)
    score, toxic = np.array([r.score for r in held]), np.array([r.toxic for r in held])
    pos, neg = score[toxic == 1], score[toxic == 0]
    assert np.mean([(pos > n).mean() + 0.5 * (pos == n).mean() for n in neg]) > 0.97
    assert (pos >= 0.5).mean() > 0.85 and (neg < 0.5).mean() > 0.98
    bins = [(score >= k / 10) & (score < (k + 1) / 10 + (k == 9)) for k in range(10)]
    assert sum(abs(score[b].mean() - toxic[b].mean()) * b.mean() for b in bins if b.any()) < 0.05  # expected calibration error


def test_every_text_with_words_has_neighbours(held):
    assert all(len(r.evidence) == t.NEIGHBOURS for r in held if r.score is not None and r.evidence) and sum(bool(r.evidence) for r in held) / len(held) > 0.99


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = t.scored(docs(spark, EDGES), t.train(docs(spark, EDGES), none)).collect()
    assert len(rows) == len(EDGES) and all(0 <= r.score < 0.5 and r.predicted == 0 and not r.evidence for r in rows)
    some = spark.createDataFrame([(4, None, 1), (3, 1, 0), (None, 1, 1), (9, 0, None), (4, None, 0)], "doc_id long, quality int, toxic int")
    got = t.scored(docs(spark, EDGES), t.train(docs(spark, EDGES), some)).collect()
    assert len(got) == len(EDGES) and [r.evidence for r in got if r.doc_id in (1, 2, 6)] == [[], [], []]
    assert t.scored(docs(spark, []), t.train(docs(spark, []), none)).count() == 0
