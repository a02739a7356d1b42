"""The stored index: phrases and proximity from its lists, its bound of memory, many chunks of a benchmark."""

import random
import resource

import numpy as np
import pytest

from sparquill.llm import decontam as D
from tests.llm.helpers import docs
from tests.llm.test_decontam import brute


def block(texts, vocab):
    n_words, terms, counts, positions = D._posted(texts)
    return D.Postings(n_words, terms.split(), counts, positions, vocab)


@pytest.mark.parametrize("expanded", [1, 50, 1 << 20])
def test_phrases_come_from_the_lists(monkeypatch, expanded):
    monkeypatch.setattr(D, "EXPANDED", expanded)
    r = random.Random(1)
    texts = [" ".join(r.choice("abcd") for _ in range(r.choice([0, 1, 3, 200]))) for _ in range(30)]
    phrases = D.Phrases([(k, " ".join(r.choice("abcde") for _ in range(r.randint(1, 5)))) for k in range(40)], 3)
    index = block(texts, phrases.vocab)
    words = {v: k.decode() for k, v in phrases.vocab.items()}
    want = set()
    for start, text in zip(index.starts.tolist(), texts, strict=True):
        own = text.split()
        for k, w in enumerate(phrases.windows.tolist()):
            w = [words[x] for x in w if x >= 0]
            want |= {(k, start + p) for p in range(len(own) - len(w) + 1) if own[p : p + len(w)] == w}
    got = [(a, b) for x, y in index.phrases(phrases.windows, phrases.sizes) for a, b in zip(x.tolist(), y.tolist(), strict=True)]
    assert set(got) == want and len(got) == len(want)


def test_stored_lists_are_read_back(spark):
    rows = [(1, "b a b"), (None, None), (2, ""), (3, "a " * 3000 + "c"), (1, "b a b")]
    got = sorted((r.term, -1 if r.doc_id is None else r.doc_id, tuple(r.positions)) for r in D.postings_table(D.build_index(docs(spark, rows))).collect())
    assert got == sorted([("b", 1, (0, 2)), ("a", 1, (1,)), ("a", 3, tuple(range(3000))), ("c", 3, (3000,)), ("b", 1, (0, 2)), ("a", 1, (1,))])


def test_one_index_serves_several_searches(spark):
    rows = [(1, "one two three four five six seven eight nine"), (2, "nine ten"), (3, None)]
    index = D.build_index(docs(spark, rows))
    for items in ([(1, "two three four five six seven eight nine")], [(5, "nine ten"), (6, "ten")], []):
        b = spark.createDataFrame(items, "item_id long, text string")
        got = sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in D.search(index, b).collect())
        assert got == brute(rows, items)


@pytest.mark.parametrize("chunk", [1 << 20, 40])
def test_random_texts_in_chunks(spark, chunk):
    r = random.Random(3)
    make = lambda n: " ".join(r.choice("ab") for _ in range(n))
    rows = [(k, make(r.choice([0, 2, 9, 40]))) for k in range(60)]
    items = [(k, make(r.choice([1, 8, 10]))) for k in range(12)]
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((x.doc_id, x.n_words, x.n_hit, list(x["items"])) for x in D.contamination(docs(spark, rows), b, chunk_bytes=chunk).collect()), key=str)
    assert got == brute(rows, items)
    kept = D.contamination(docs(spark, rows), b, chunk_bytes=chunk, keep_row=True).select("doc_id", "row").collect()
    assert sorted((x.row.doc_id, x.row.text) for x in kept) == sorted(rows) and all(x.doc_id == x.row.doc_id for x in kept)


def test_memory_of_two_word_texts():
    r = np.random.default_rng(4)
    word = np.array(["ab", "cd"])
    text = " ".join(word[r.integers(0, 2, 270_000)])  # 0.8 MB
    phrases = D.Phrases([(k, " ".join(word[r.integers(0, 2, 19)])) for k in range(20)])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    index = block([text], phrases.vocab)
    hit, items = D._occurring(index, phrases)
    assert hit.any() and len(items[0]) == 20
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500 << 10  # kilobytes


def test_proximity_over_chunks(spark):
    index = D.build_index(docs(spark, [(1, "alpha x beta y y gamma"), (2, "delta beta"), (3, "delta"), (4, "beta")]))
    b = spark.createDataFrame([(9, "gamma alpha beta"), (8, "beta delta"), (7, "x y")], "item_id long, text string")
    one, many = (sorted(map(tuple, D.proximity_matches(index, b, reach=6, chunk_bytes=n).collect())) for n in (1 << 20, 8))
    assert one == many and {(r[0], r[1]) for r in one} == {(1, 9), (2, 8), (1, 7)}
