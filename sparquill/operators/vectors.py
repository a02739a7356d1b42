"""Exact nearest neighbours in numpy blocks inside Arrow batches.

Within groups every pair of blocks of a group is one task's work, so a hot group spreads over the
cluster; each task returns its best k per anchor and a window keeps the best of those.  Against a
corpus, queries go to the tasks in chunks of a checked size and the corpus is never moved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparquill.runtime import write_table

#: Vectors per block of a group.
BLOCK = 2048
#: Queries that go to the tasks at once.
QUERY_CHUNK = 4096
#: Queries that a task compares with a block at once, and candidates whose scores it sums at once: its memory, whatever the number of queries.
QUERY_BLOCK, PIECE = 256, 16384


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.empty((0, 0))


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest scores per row, ties by id ascending."""
    order = np.argsort(ids, kind="stable")
    part = np.argsort(-scores[:, order], axis=1, kind="stable")[:, :k]
    return order[part]


def neighbours_in_group(rows: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """``rows(group, id, vector)`` to ``(group, anchor, rank, id, score)``: the k best of the anchor's group, itself included.

    Scores are inner products in double precision; ties by id.  Rows with a null vector are left out;
    vectors of a group must have one length.
    """
    rows = rows.where("vector IS NOT NULL AND id IS NOT NULL").select(F.coalesce(F.col("group").cast("string"), F.lit("")).alias("group"), F.col("id").cast("long"), F.col("vector").cast("array<double>"))
    sizes = rows.groupBy("group").agg(F.ceil(F.count("*") / block).cast("int").alias("n_blocks"))
    dealt = rows.join(sizes, "group").withColumn("own", F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    as_anchor = dealt.select("group", F.col("own").alias("a"), other.alias("b"), "id", "vector", F.lit(True).alias("is_anchor"))
    as_found = dealt.select("group", other.alias("a"), F.col("own").alias("b"), "id", "vector", F.lit(False).alias("is_anchor"))

    def best(key: tuple, table: pa.Table) -> pa.Table:
        flag = table.column("is_anchor").to_numpy()
        ids, x = table.column("id").to_numpy(), _matrix(table.column("vector"))
        anchors, found = ids[flag], ids[~flag]
        out: list[np.ndarray] = [np.empty((0, 2), np.int64)]
        scores: list[np.ndarray] = [np.empty(0)]
        for at in range(0, len(anchors), 256):
            s = x[flag][at : at + 256] @ x[~flag].T
            top = _top(s, found, k)
            own = np.arange(len(top))[:, None]
            out.append(np.stack((np.repeat(anchors[at : at + 256], top.shape[1]), found[top].ravel()), axis=1))
            scores.append(s[own, top].ravel())
        pairs = np.concatenate(out)
        return pa.table({"group": pa.array([key[0].as_py()] * len(pairs), pa.string()), "anchor": pairs[:, 0], "id": pairs[:, 1], "score": np.concatenate(scores)})

    partial = as_anchor.union(as_found).groupBy("group", "a", "b").applyInArrow(best, "group string, anchor long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("group", "anchor").orderBy(F.col("score").desc(), "id"))
    return partial.withColumn("rank", rank).where(F.col("rank") <= k).select("group", "anchor", "rank", "id", "score")


def search(corpus: DataFrame, queries: DataFrame, k: int, chunk: int = QUERY_CHUNK) -> DataFrame:
    """``corpus(id, vector)``, ``queries(query_id, vector)`` to ``(query_id, rank, id, score)``: the exact k best by inner product.

    k may exceed the corpus.  Null vectors are left out; ties by id.
    """
    corpus = corpus.where("vector IS NOT NULL").select(F.col("id").cast("long"), F.col("vector").cast("array<double>"))
    asked = write_table(queries.select("query_id", F.col("vector").cast("array<double>")), "queries").where("vector IS NOT NULL")  # a model behind them runs once
    n_chunks = max(1, -(-asked.count() // chunk))
    found = None
    for c in range(n_chunks):
        part = asked if n_chunks == 1 else asked.where(F.pmod(F.xxhash64("query_id"), F.lit(n_chunks)) == c)
        table = part.toArrow()
        one = corpus.mapInArrow(_searcher(table.column("query_id"), _matrix(table.column("vector")), k), "q int, id long, score double")
        names = part.sparkSession.createDataFrame(pa.table({"q": pa.array(range(table.num_rows), pa.int32()), "query_id": table.column("query_id")}))
        best = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "id"))
        one = one.withColumn("rank", best).where(F.col("rank") <= k).join(F.broadcast(names), "q").select("query_id", "rank", "id", "score")
        found = one if found is None else found.unionByName(one)
    return found


class _Best:
    """The k best of a block of queries so far, as flat (row, id, score) in order of row and rank.

    A block product finds the candidates, with room for its rounding; what it finds is summed again one by
    one, so that equal vectors have equal scores wherever they stand and ties go by id.
    """

    def __init__(self, q: np.ndarray, k: int) -> None:
        self.q, self.k = q, k
        self.rows, self.ids, self.scores = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0)
        self.bound = np.full(len(q), -np.inf)
        self.room = 4 * q.shape[1] * np.finfo(float).eps * np.sqrt((q * q).sum(axis=1))

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        s = self.q @ x.T
        room = self.room * np.sqrt(np.fmax.reduce((x * x).sum(axis=1)))
        found = ~(s < (self.bound - room)[:, None])
        if s.shape[1] > self.k and found.sum() > 4 * self.k * len(s):
            own = -np.partition(-s, self.k - 1, axis=1)[:, self.k - 1]
            found &= ~(s < (own - 2 * room)[:, None])
        row, col = np.nonzero(found)
        if not len(row):
            return
        exact = np.concatenate([(self.q[row[at : at + PIECE]] * x[col[at : at + PIECE]]).sum(axis=1) for at in range(0, len(row), PIECE)])
        rows, ids, scores = np.concatenate((self.rows, row.astype(np.int32))), np.concatenate((self.ids, ids[col])), np.concatenate((self.scores, exact))
        order = np.lexsort((ids, -scores, rows))
        rows = rows[order]
        starts = np.searchsorted(rows, np.arange(len(self.q)))
        rank = np.arange(len(rows)) - starts[rows]
        keep = order[rank < self.k]
        self.rows, self.ids, self.scores = rows[rank < self.k], ids[keep], scores[keep]
        last = rank == self.k - 1
        self.bound[rows[last]] = scores[order[last]]


def _searcher(query_ids, q: np.ndarray, k: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(q[at : at + QUERY_BLOCK], k) for at in range(0, len(q), QUERY_BLOCK)] if k > 0 else []
        for batch in batches:
            if not batch.num_rows or not best:
                continue
            own, x = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1))
            for at in range(0, len(own), BLOCK):
                for b in best:
                    b.add(own[at : at + BLOCK], x[at : at + BLOCK])
        for n, b in enumerate(best):
            if len(b.rows):
                yield pa.RecordBatch.from_arrays([pa.array(b.rows + np.int32(n * QUERY_BLOCK)), pa.array(b.ids), pa.array(b.scores)], names=["q", "id", "score"])

    return scan
