"""Embedding near-dedup with a forest of random-projection trees.

Every tree splits recursively: at each depth it has a random direction, and each node a threshold.
Vectors within ``margin`` of the threshold go to both sides (spill), so close vectors rarely part,
and then in one tree only.  The forest is fitted on a bounded sample (:data:`SAMPLE` vectors):
thresholds are medians of the sample's nodes and, below them, of the whole sample, so what is sent to
the tasks stays bounded however deep the trees grow.  All vectors are indexed.

Within a leaf all pairs are compared in double precision.  A pair that meets in several leaves is
counted in the first of them only, which a task tells from the forest alone.  Tasks return link
counts per vector and a spanning forest of the links, not the pairs.  Equal vectors are one class
with a multiplicity; leaves beyond :data:`BLOCK` vectors are dealt out as pairs of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.llm._runtime import read, write_table
from sparquill.llm.components import connected_components, joined_with_least

THRESHOLD = 0.95
TREES = 4
MARGIN = 0.03
LEAF = 480
BLOCK = 4096
#: Vectors that the forest is fitted on at most, and their bytes.
SAMPLE, SAMPLE_BYTES = 16_384, 32 << 20
SEED = 7


class Forest:
    """Directions per tree and depth; thresholds per node down to ``known`` depths, then per depth."""

    def __init__(self, sample: np.ndarray, n: int, trees: int = TREES, margin: float = MARGIN, leaf: int = LEAF, seed: int = SEED) -> None:
        dim = sample.shape[1] if sample.size else 1
        self.trees, self.margin = trees, margin
        self.depth = min(40, max(0, math.ceil(math.log2(max(1, n) / leaf))))
        known = min(self.depth, max(0, int(math.log2(max(1, len(sample)) / 32))))
        r = np.random.default_rng(seed)
        self.directions = r.standard_normal((trees, max(1, self.depth), dim))
        self.directions /= np.linalg.norm(self.directions, axis=2, keepdims=True)
        self.medians = np.zeros((trees, max(1, self.depth)))
        self.nodes: list[list[np.ndarray]] = []
        for t in range(trees):
            node, levels = np.zeros(len(sample), np.int64), []
            for d in range(self.depth):
                p = sample @ self.directions[t, d] if len(sample) else np.empty(0)
                self.medians[t, d] = np.median(p) if len(p) else 0.0
                if d >= known:
                    continue
                own = np.full(1 << d, self.medians[t, d])
                order = np.argsort(node, kind="stable")
                heads = np.searchsorted(node[order], np.arange((1 << d) + 1))
                for k in range(1 << d):
                    if heads[k + 1] > heads[k]:
                        own[k] = np.median(p[order[heads[k] : heads[k + 1]]])
                levels.append(own)
                node = node * 2 + (p > own[node])
            self.nodes.append(levels)

    def leaves(self, x: np.ndarray, tree: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of unit vectors; rows near thresholds have several leaves."""
        row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        for d in range(self.depth):
            levels = self.nodes[tree]
            at = levels[d][node] if d < len(levels) else self.medians[tree, d]
            gap = (x @ self.directions[tree, d])[row] - at
            left, right = gap <= self.margin, gap >= -self.margin
            row, node = np.concatenate((row[left], row[right])), np.concatenate((node[left] * 2, node[right] * 2 + 1))
        return row, node


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of the components can neither over- nor underflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _packed(kind: str):
    """Vectors as bytes; null for those that link with nothing."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column(1):
                x = None if not v.is_valid else v.values
                if x is None or len(x) == 0 or x.null_count:
                    out.append(None)
                    continue
                x = x.to_numpy(zero_copy_only=False).astype(kind) + np.array(0, kind)  # -0.0 becomes 0.0
                out.append(x.tobytes() if np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "v"])

    return scan


def _assigned(forest: Forest, kind: str, with_vector: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                x = _unit(batch.column(2).to_pylist(), kind)
                for t in range(forest.trees):
                    row, leaf = forest.leaves(x, t)
                    pick = pa.array(row)
                    cols = [pa.array(np.full(len(row), t, np.int32)), pa.array(leaf)]
                    names = ["tree", "leaf"]
                    if with_vector:
                        cols += [batch.column(k).take(pick) for k in range(3)]
                        names += ["cid", "m", "v"]
                    yield pa.RecordBatch.from_arrays(cols, names=names)

    return scan


def _compare(forest: Forest, kind: str, threshold: float):
    """Links of a leaf, or of two blocks of one: rows (cid, other, n) with n links, or an edge where n is null."""

    def first_common(x: np.ndarray, a: np.ndarray, b: np.ndarray, tree: int, leaf: int) -> np.ndarray:
        """Whether (tree, leaf) is the first leaf that rows a and b share."""
        ok = np.ones(len(a), bool)
        for t in range(tree + 1):
            row, leaves = forest.leaves(x, t)
            order = np.lexsort((leaves, row))
            row, leaves = row[order], leaves[order]
            count = np.bincount(row, minlength=len(x))
            rank = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            table = np.full((len(x), count.max()), -1, np.int64)
            table[row, rank] = leaves
            for k in range(table.shape[1]):
                own = table[a, k]
                hit = (own >= 0) & (table[b] == own[:, None]).any(axis=1)
                if t == tree:
                    hit &= own < leaf
                ok &= ~hit
        return ok

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        tree, leaf, lo, hi = (k.as_py() for k in key)
        cid, m = table.column("cid").to_numpy(), table.column("m").to_numpy()
        block = table.column("block").to_numpy()
        x = _unit(table.column("v").to_pylist(), kind)
        n = len(x)
        counts = np.zeros(n, np.int64)
        parent = np.arange(n)
        edges: list[tuple[int, int]] = []

        def find(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = int(parent[i])
            return i

        for s in range(0, n, 512):
            cos = x[s : s + 512] @ x[s:].T
            a, b = np.nonzero(cos >= threshold)
            a, b = a + s, b + s
            ok = a < b
            if lo != hi:
                ok &= block[a] != block[b]
            a, b = a[ok], b[ok]
            if not len(a):
                continue
            used = np.unique(np.concatenate((a, b)))
            where = np.zeros(n, np.int64)
            where[used] = np.arange(len(used))
            for k in range(0, len(a), 200_000):
                p, q = a[k : k + 200_000], b[k : k + 200_000]
                own = first_common(x[used], where[p], where[q], tree, leaf)
                p, q = p[own], q[own]
                counts += np.bincount(p, m[q], n).astype(np.int64) + np.bincount(q, m[p], n).astype(np.int64)
                for i, j in zip(p.tolist(), q.tolist(), strict=True):
                    ri, rj = find(i), find(j)
                    if ri != rj:
                        parent[max(ri, rj)] = min(ri, rj)
                        edges.append((i, j))
        linked = np.flatnonzero(counts)
        e = np.array(edges, np.int64).reshape(-1, 2)
        return pa.table(
            {
                "cid": pa.array(np.concatenate((cid[linked], cid[e[:, 0]]))),
                "other": pa.concat_arrays([pa.nulls(len(linked), pa.int64()), pa.array(cid[e[:, 1]])]),
                "n": pa.concat_arrays([pa.array(counts[linked]), pa.nulls(len(e), pa.int64())]),
            }
        )

    return compare


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, margin: float = MARGIN, leaf: int = LEAF, block: int = BLOCK, sample: int = SAMPLE
) -> DataFrame:
    """``vectors(vec_id, embedding)`` to ``(vec_id, n_links, component_id, kept)``, one row per input row.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing: no links,
    their own component, kept.  Equal vectors link with each other.  ``component_id`` is the smallest
    vec_id reachable (null ids never name a component; a row with a null id that links with nothing has
    component null and kept null).  Vectors of different lengths are compared only with their own length.
    """
    element = vectors.schema["embedding"].dataType.elementType.simpleString()
    kind = "<f4" if element == "float" else "<f8"
    rows = write_table(
        vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(f"array<{'float' if kind == '<f4' else 'double'}>")).mapInArrow(_packed(kind), "vec_id long, v binary"), "vectors"
    )
    grouped = rows.where("v IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m"))
    classes = write_table(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    found = None
    for r in classes.groupBy(F.length("v").alias("size")).count().orderBy("size").collect():
        part = classes.where(F.length("v") == r["size"]).select("cid", "m", "v")
        chosen = part.orderBy(F.xxhash64("v"), "cid").limit(max(1, min(sample, SAMPLE_BYTES // r["size"]))).select("v").collect()
        forest = Forest(_unit([c[0] for c in chosen], kind), r["count"], trees, margin, leaf)
        large = part.mapInArrow(_assigned(forest, kind, False), "tree int, leaf long").groupBy("tree", "leaf").count().where(F.col("count") > block)
        assigned = part.mapInArrow(_assigned(forest, kind, True), "tree int, leaf long, cid long, m long, v binary").join(large, ["tree", "leaf"], "left")
        n = F.coalesce(F.ceil(F.col("count") / (block / 2)), F.lit(1)).cast("int")
        dealt = assigned.withColumn("block", F.pmod(F.xxhash64("cid"), n).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), n - 1)))
        one = (
            dealt.select("tree", "leaf", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"), "cid", "m", "v", "block")
            .groupBy("tree", "leaf", "lo", "hi")
            .applyInArrow(_compare(forest, kind, threshold), "cid long, other long, n long")
        )
        found = one if found is None else found.union(one)
    if found is None:
        alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return alone.withColumn("kept", F.col("vec_id") == F.col("component_id"))
    found = write_table(found, "links")
    counts = found.where("n IS NOT NULL").groupBy("cid").agg(F.sum("n").alias("n"))
    labels = connected_components(found.where("other IS NOT NULL").select(F.col("cid").alias("a"), F.col("other").alias("b")))
    named = classes.join(counts, "cid", "left").join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    per_class = joined_with_least(write_table(named, "named"), "component", "rep", "component_id").select("v", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id")
    return rows.join(per_class, "v", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"),
    )


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))


OP3_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), u AS (SELECT vec_id, e FROM v WHERE list_dot_product(e, e) > 0
), pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a, u b
  WHERE a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.95
), reach AS (
  SELECT vec_id AS node, vec_id AS r FROM embeddings
  UNION
  SELECT reach.node, pairs.b FROM reach JOIN pairs ON reach.r = pairs.a
), comp AS (SELECT node, min(r) AS component_id FROM reach GROUP BY node
), deg AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN deg ON a = vec_id JOIN comp ON node = vec_id
"""
