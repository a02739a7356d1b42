import hashlib
import random

import numpy as np
import pytest

from sparquill.llm import suffix_dedup as S
from tests.llm.helpers import docs


def brute(rows, width=50):
    first = {}
    big = 1 << 70
    raws = [(big if d is None else d, (t or "").encode()) for d, t in rows]
    for d, raw in raws:
        for k in range(len(raw) - width + 1):
            s = raw[k : k + width]
            first[s] = min(first.get(s, big), d)
    out = []
    for (d, _), (own, raw) in zip(rows, raws, strict=True):
        gone = bytearray(len(raw))
        for k in range(len(raw) - width + 1):
            if first[raw[k : k + width]] < own:
                gone[k : k + width] = b"\1" * width
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        rest = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((d, len(raw), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def table():
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 9)))
    passages = [" ".join(word() for _ in range(n)) for n in (9, 12, 20, 60)]
    rows = []
    for k in range(60):
        parts = [" ".join(word() for _ in range(r.randint(0, 40))) for _ in range(3)]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, 30)
            parts.insert(r.randint(0, 3), p[a:] if r.random() < 0.5 else p)
        rows.append((r.randint(0, 70), " ".join(parts)))
    rows += [(99, "ab" * 400), (98, "ab" * 200), (97, "a" * 300), (96, "a" * 120), (3, None), (4, ""), (None, passages[3]), (None, passages[3]), (80, passages[3]), (80, passages[3]), (81, "x" * 49), (82, "x" * 49), (83, "y" * 50), (84, "y" * 50)]
    r.shuffle(rows)
    return rows


def small(monkeypatch, on):
    if on:
        monkeypatch.setattr(S, "SEGMENT_BYTES", 700)
        monkeypatch.setattr(S, "BUCKET_ANCHORS", 200)
        monkeypatch.setattr(S, "BATCH", 64)


@pytest.mark.parametrize(("parts", "forced"), [(1, False), (5, False), (5, True)])
def test_against_brute_force(spark, parts, forced, monkeypatch):
    """``forced``: many segments, buckets, batches and levels."""
    small(monkeypatch, forced)
    rows = table()
    got = S.remove_repeats(docs(spark, rows).repartition(parts)).drop("rest").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


@pytest.mark.parametrize("forced", [False, True])
def test_batches_of_a_family_equal_one_batch(spark, forced, monkeypatch):
    small(monkeypatch, forced)
    rows = table()
    family = S.SuffixFamily(base=4000)
    got = []
    for a, b in ((0, 20), (20, 30), (30, 45), (45, 81), (81, 1 << 70)):
        own = [r for r in rows if a <= (1 << 60 if r[0] is None else r[0]) < b]
        got += S.remove_repeats(docs(spark, own), family=family).drop("rest").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    assert family.batches == 5 and 1 < len(family.levels) < 5 and family.n_bytes == sum(len((t or "").encode()) for _, t in rows)


def test_later_batches_meet_all_levels(spark):
    rows = [(k, "z" * k + " a passage of more than fifty bytes that is in all of the documents " + "y" * k) for k in (5, 3, 9, 7)]
    family = S.SuffixFamily(base=1)
    for k, row in enumerate(rows):  # ids in no order: a result stays as it was given
        got = tuple(S.remove_repeats(docs(spark, [row]), family=family).drop("rest").first())
        assert got in brute(rows[: k + 1])


def test_levels_are_suffix_arrays():
    r = np.random.default_rng(1)
    raw = r.choice(np.frombuffer(b"ab\0", np.uint8), 3000)
    at, doc = r.integers(0, 2900, 2000), np.sort(r.integers(0, 99, 2000))
    family, least = S.LevelFamily(base=64), {}
    for a in range(0, 2000, 64):
        own = S._strings(raw, at[a : a + 64], 8)
        for k, d in zip(at[a : a + 64], doc[a : a + 64], strict=True):
            least.setdefault(raw[k : k + 8].tobytes(), d)
        assert family.take(own, doc[a : a + 64]).tolist() == [least[raw[k : k + 8].tobytes()] for k in at[a : a + 64]]
    assert len(family.levels) > 1 and sum(len(x) for x, _ in family.levels.values()) == len(least)
    for held, _ in family.levels.values():
        strings = [bytes(x).ljust(8, b"\0") for x in held.tolist()]
        assert strings == sorted(set(strings))


def test_alike_tells_padding_from_zeros():
    raw = np.frombuffer(b"ab\0ab\0\0abab\0", np.uint8)
    begin, length = np.array([0, 0, 3, 3, 7, 9]), np.array([2, 3, 3, 4, 2, 3])
    assert [list(S._alike(raw, begin, length)).index(g) for g in S._alike(raw, begin, length)] == [0, 1, 1, 3, 0, 1]


def test_long_texts(spark):
    r = random.Random(5)
    shared = "".join(r.choice("abcdefgh ") for _ in range(400_000))
    rows = [(1, shared), (2, "x" + shared[1000:] + "y"), (3, "q" * 300_000), (4, "q" * 100)]
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans) for x in S.remove_repeats(docs(spark, rows)).collect()}
    assert got == {1: (400_000, 0, 0), 2: (399_002, 399_000, 1), 3: (300_000, 0, 0), 4: (100, 100, 1)}


def test_text_is_kept_on_demand(spark):
    r = {x.doc_id: x for x in S.remove_repeats(docs(spark, [(1, "q" * 60), (2, "start " + "q" * 60 + " end")]), keep_text=True).collect()}
    assert bytes(r[2].rest) == b"start  end" and bytes(r[1].rest) == b"q" * 60
    assert S.remove_repeats(docs(spark, [])).count() == 0
