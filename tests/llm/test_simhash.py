import random

import numpy as np
import pytest
import xxhash

from sparquill.llm import simhash as S
from tests.conftest import SMALL
from tests.llm.helpers import docs, documents


def naive(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows):
    """Brute force over (doc_id, fingerprint)."""
    ids = [d for d, _ in rows]
    fps = [f for _, f in rows]
    comp = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= 4 and comp[i] != comp[j]:
                    comp[i] = comp[j] = min(comp[i], comp[j])
                    changed = True
    least = {}
    for i, c in enumerate(comp):
        least[c] = min(least.get(c, ids[i]), ids[i])
    return [least[c] for c in comp]


@pytest.mark.parametrize("text", ["", None, "one", "A b C d e f", "é É ü x\x0by  z\n\nq", "a a a a a a a a", "w x y z"])
def test_fingerprint(text):
    assert S.fingerprint(text) == naive(text)


def test_golay_code_is_perfect():
    words = np.random.default_rng(1).integers(0, 1 << 23, 5000).astype(np.uint32)
    high, _ = S._golay()
    index = S.decode(words)
    codeword = (index << 11) | high[index]
    assert (np.bitwise_count(codeword ^ words) <= 3).all()


@pytest.mark.parametrize("bits", range(5))
def test_near_fingerprints_share_a_key(bits):
    r = random.Random(bits)
    a = np.array([r.getrandbits(64) for _ in range(400)], np.uint64)
    b = np.array([int(x) ^ sum(1 << k for k in r.sample(range(64), bits)) for x in a], np.uint64)
    own = [{}, {}]
    for side, fps in enumerate((a, b)):
        for row, key in zip(*S.fuzzy_keys(fps), strict=True):
            own[side].setdefault(int(row), set()).add(int(key))
    assert all(own[0][k] & own[1][k] for k in range(400))


def test_links_give_the_components_of_all_pairs(spark):
    r = random.Random(9)
    fps = [r.getrandbits(64) for _ in range(60)]
    for _ in range(240):  # chains and dense groups
        x = r.choice(fps)
        fps.append(x ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 6))))
    rows = [(k, f) for k, f in enumerate(dict.fromkeys(fps))]
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    from sparquill.llm.components import connected_components

    found = connected_components(S.links(spark.createDataFrame([(signed(f),) for _, f in rows], "fp long"))).collect()
    comp = {x.node: x.component for x in found}
    groups = {}
    for (k, f), c in zip(rows, components(rows), strict=True):
        groups.setdefault(c, set()).add(comp.get(signed(f), signed(f)))
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_query_against_brute_force(spark):
    d = documents(spark, SMALL)
    rows = {r.doc_id: r for r in S.near_duplicates(d).collect()}
    own = [(r.doc_id, naive(r.text)) for r in d.orderBy("doc_id").collect()]
    for (doc_id, fp), c in zip(own, components(own), strict=True):
        assert rows[doc_id].fingerprint == f"{fp:016x}" and rows[doc_id].component_id == c


def test_edges(spark):
    rows = S.near_duplicates(docs(spark, [(3, None), (1, ""), (2, " "), (7, "a b c d e"), (7, "a b c d e"), (None, "a b c d e"), (None, "quite another text here")])).collect()
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.component_id if r.component_id is not None else -1) for r in rows)
    assert got == [(-1, -1), (-1, 7), (1, 1), (2, 1), (3, 1), (7, 7), (7, 7)]
    assert S.near_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize("piece", [1, 7, 50])
def test_pieces_of_long_texts(monkeypatch, piece):
    monkeypatch.setattr(S, "PIECE", piece)
    r = random.Random(9)
    texts = [" ".join("ab"[r.randrange(2)] * r.randint(1, 4) for _ in range(n)) for n in (0, 1, 3, 4, 5, 40)] + ["  x\ty \x0b z  w", "q" * 99]
    assert [S.fingerprint(t) for t in texts] == [naive(t) for t in texts]
