import numpy as np
import pytest

from sparquill.llm import embed_dedup as E

SCHEMA = "vec_id long, embedding array<{}>, label int, cid long, v string, m int"


def brute(rows, threshold=0.95):
    ok = [x is not None and len(x) > 0 and all(c is not None and np.isfinite(c) for c in x) and any(x) for _, x in rows]
    n = len(rows)
    link = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                link[i, j] = link[j, i] = a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold
    comp = list(range(n))
    for _ in range(n):
        new = [min([comp[i], *(comp[j] for j in np.flatnonzero(link[i]))]) for i in range(n)]
        if new == comp:
            break
        comp = new
    big = 1 << 62
    least = {}
    for i, c in enumerate(comp):
        least[c] = min(least.get(c, big), big if rows[i][0] is None else rows[i][0])
    return sorted(((r[0], int(link[i].sum()), None if least[comp[i]] == big else least[comp[i]]) for i, r in enumerate(rows)), key=str)


def table(spark, rows, kind="float"):
    return spark.createDataFrame([(i, x, 1, 2, "v", 3) for i, x in rows], SCHEMA.format(kind))


def planted():
    r = np.random.default_rng(3)
    base = r.standard_normal((150, 16)).astype(np.float32)
    rows = [(k, [float(v) for v in x]) for k, x in enumerate(base)]
    for k in range(150):
        x = base[r.integers(0, 12)] + r.standard_normal(16).astype(np.float32) * r.choice([0.02, 0.15, 0.3])
        rows.append((1000 - k, [float(v) for v in x.astype(np.float32)]))
    rows += [(2000, rows[3][1]), (2001, rows[3][1]), (2002, [v * 2 for v in rows[3][1]]), (2003, None), (2004, []), (2005, [0.0] * 16), (2006, [float("nan")] + [1.0] * 15), (2007, [None] + [1.0] * 15), (2008, [float("inf")] * 16), (5, rows[5][1]), (None, rows[5][1]), (None, [1.0] * 16), (2010, [1.0, 2.0]), (2011, [2.0, 4.0]), (2012, [1e-30] * 16)]
    return rows


@pytest.mark.parametrize(("leaf", "block"), [(1024, 4096), (16, 4096), (16, 12)])
def test_against_brute_force(spark, leaf, block):
    rows = planted()
    got = E.near_duplicates(table(spark, rows), leaf=leaf, block=block, margin=0.12).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_doubles_and_empty(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 1e-9])]
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in E.near_duplicates(table(spark, rows, "double")).collect()) == [(1, 1, 1, True), (2, 1, 1, False)]
    assert E.near_duplicates(table(spark, [])).count() == 0
    assert [r.n_links for r in E.near_duplicates(table(spark, [(1, None)])).collect()] == [0]


def test_leaves_are_recalled():
    r = np.random.default_rng(5)
    x = r.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    e = r.standard_normal(x.shape)
    e -= (e * x).sum(axis=1, keepdims=True) * x
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * e  # every pair exactly at the threshold
    forest = E.Forest(x[:1000], 64_000)
    met = np.zeros(len(x), bool)
    for t in range(forest.trees):
        own = [set() for _ in x]
        for row, leaf in zip(*(v.tolist() for v in forest.leaves(x, t)), strict=True):
            own[row].add(leaf)
        for row, leaf in zip(*(v.tolist() for v in forest.leaves(y, t)), strict=True):
            met[row] |= leaf in own[row]
    assert met.mean() > 0.999


def test_very_large_and_small_components(spark):
    rows = [(1, [1e200, 0.0]), (2, [1e200, 0.0]), (3, [2e200, 0.0]), (4, [1e-200, 0.0]), (5, [0.0, 1e-200]), (6, [0.0, 5e-324]), (7, [1e308, 1e308])]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in E.near_duplicates(table(spark, rows, "double")).collect())
    assert got == [(1, 3, 1), (2, 3, 1), (3, 3, 1), (4, 3, 1), (5, 1, 5), (6, 1, 5), (7, 0, 7)]


def test_components_of_a_hub(spark):
    """A star of many leaves, a chain and lone pairs, by the smallest node."""
    from sparquill.llm.components import connected_components

    edges = [(5000, k) for k in range(1, 1200)] + [(k, k + 1) for k in range(6000, 6040)] + [(7000, 7001), (7003, 7002), (7004, 7004), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {5000: 1, **{k: 1 for k in range(1, 1200)}, **{k: 6000 for k in range(6000, 6041)}, 7000: 7000, 7001: 7000, 7002: 7002, 7003: 7002}
