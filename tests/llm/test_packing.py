from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparquill.llm import packing
from sparquill.llm.tokens import CachedTokenizer
from tests.conftest import SMALL
from tests.llm.helpers import docs, documents

TEXTS = ["", "a", "Don't stop, it's 12.5% OK...", "ΟΔΟΣ Σ", "x\x1cy", "İstanbul é é", "say <|endoftext|> now", "\n \t", "word " * 5000, "a,b. c!? 'tis", "ß ﬁ ① 1²3"]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_cached_ids_are_the_tokenizers(plain):
    for most in (600_000, 1):
        cached = CachedTokenizer(most=most)
        for _ in range(2):
            flat, lengths = cached.encode([*TEXTS, None])
            expected = [plain.encode(t, add_special_tokens=False).ids for t in TEXTS] + [[]]
            assert lengths.tolist() == [len(e) for e in expected]
            assert flat.tolist() == [i for e in expected for i in e]


def test_pieces_of_long_texts(plain, monkeypatch):
    from sparquill.llm import tokens

    monkeypatch.setattr(tokens, "PIECE", 9)
    flat, lengths = CachedTokenizer().encode([*TEXTS, None])
    expected = [plain.encode(t, add_special_tokens=False).ids for t in TEXTS] + [[]]
    assert lengths.tolist() == [len(e) for e in expected] and flat.tolist() == [i for e in expected for i in e]


def check(rows, expected, window=2048):
    """expected: multiset of (doc_id, ids with the end id)."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for d, ids in expected.items():
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    sizes = []
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        sizes.append(at)
    return sizes


def test_round_trip(spark, plain):
    d = documents(spark, SMALL)
    rows = packing.pack(d.repartition(3)).collect()
    expected = {r.doc_id: [*plain.encode(r.text, add_special_tokens=False).ids, 1] for r in d.collect()}
    sizes = check(rows, expected)
    assert sum(s < 2048 for s in sizes) <= 1


def test_edges(spark, plain):
    rows = [(1, None), (2, ""), (3, "word " * 9000), (4, TEXTS[6])]
    found = packing.pack(docs(spark, rows)).collect()
    check(found, {d: [*plain.encode(t or "", add_special_tokens=False).ids, 1] for d, t in rows})
    repeated = packing.pack(docs(spark, [(5, "same text"), (5, "same text"), (None, "x")])).collect()
    assert sorted((r.doc_id or -1, r.start) for r in repeated) == [(-1, 0), (5, 0), (5, 0)]
    assert packing.pack(docs(spark, [])).count() == 0


def test_places_by_sum_of_squares():
    p = packing.SumOfSquares(10)
    for k, n in enumerate((6, 6, 4, 3)):
        p.add(k, np.zeros(n, np.uint32))
    # 4 fills a window of 6; 3 then goes on the other one of 6 (level 9) rather than to a new window of level 3
    assert [sorted(x[0] for x in w) for w in p.closed] == [[1, 2]]
    assert p.levels[9] == 1 and p.n_open == 1
    left = p.run_together()
    assert sum(len(x[2]) for x in left) == 9 and p.n_open == 0


@pytest.mark.parametrize("sizes", [[60], [60, 1, 99, 35, 70]])
def test_open_windows_stay_bounded(sizes):
    """Beyond the bound an item fills the fullest window and the rest of it goes by the rule."""
    p = packing.SumOfSquares(100, max_open=8)
    for k in range(200):
        p.add(k, np.arange(sizes[k % len(sizes)], dtype=np.uint32))
        assert p.n_open <= 8 and p.n_open == p.levels.sum() and all(sum(len(x[2]) for x in w) == 100 for w in p.closed)
    windows = p.take()
    left = p.run_together()
    pieces = sorted((x[0], x[1], x[2].tolist()) for w in [*windows, *p.closed, left] for x in w)
    for k in range(200):
        assert [i for d, _, ids in pieces if d == k for i in ids] == list(range(sizes[k % len(sizes)]))


def test_the_bound_is_not_met_by_the_documents(spark):
    """Forty times the documents in one packer: every placement is by the rule."""
    sizes = [r.n for r in documents(spark, SMALL.replace("sf0.001", "sf0.01")).selectExpr("size(split(text, ' ')) + 1 AS n").collect()]
    p, most = packing.SumOfSquares(), 0
    for k in range(40):
        for j, n in enumerate(sizes):
            p.add(k * len(sizes) + j, np.zeros(max(1, n), np.uint8))
            most = max(most, p.n_open)
        p.take()
    assert most < packing.MAX_OPEN


def test_counts_need_no_ids(monkeypatch):
    import numpy as np

    from sparquill.llm import edit_counts, tokens

    texts = [*TEXTS, None, "", "new, words. of\x1cone <| text", "İstanbul", "a b " * 40, "hi, " + "x1-y " * 3]
    expected = CachedTokenizer().encode(texts)[1].tolist()
    assert CachedTokenizer().counts(texts).tolist() == expected
    monkeypatch.setattr(tokens, "PIECE", 5)
    assert CachedTokenizer().counts(texts).tolist() == expected
    assert CachedTokenizer().counts([]).tolist() == []
    enc = CachedTokenizer()
    monkeypatch.setattr(enc, "encode", None)  # a use of it raises
    text = "some words, and more of them. " * 60
    parts = edit_counts.segments_of(text)
    tree = edit_counts.CountTree(parts, enc.counts(parts).tolist(), enc)
    tree.edit(100, 3, "put in ")
    again = edit_counts.CountTree.kept(tree.text, tree.state(), enc)
    assert tree.n_tokens == again.n_tokens == int(enc.counts([text[:100] + "put in " + text[103:]])[0])
    assert again.segments == tree.segments and np.array_equal(again.sums, tree.sums)
