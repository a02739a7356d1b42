"""Sum-of-squares online packing of tokenised documents into fixed windows.

Every task packs its own documents in one pass.  A document's full windows go out at once; the
rest is an item, placed into the fill level for which the sum over levels of (open windows at
that level)^2 ends up smallest (an exact fit or the fuller level on ties).  The counts are a
level array of the window's length, so a placement is one vectorised scan of it.  Open windows
are bounded in memory (:data:`MAX_OPEN`, 64 MB of ids): with that many open, an item first fills up
and closes the fullest one, and what is left of it is placed by the rule, so there are never more.
At the end of a task's documents its open windows are run together; less than one window is left,
and those tails are packed again by the same rule in groups of ``fan_in`` tasks, so about one window
in every ``fan_in`` tasks is padded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.llm._runtime import read, sliced, text_columns, write_table
from sparquill.llm.tokens import TOKENIZER, tokenizer

WINDOW = 2048
END_ID = 1
#: Open windows at most; sizes that pair up stay far below (see the README for figures).
MAX_OPEN = 8192
FAN_IN = 256
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())]
)
_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


class SumOfSquares:
    """Online packer; pieces are (doc_id, start, ids, doc_tokens), ids little-endian uint32."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN) -> None:
        self.window, self.max_open = window, max_open
        self.levels = np.zeros(window + 1, np.int64)
        self.open: list[list[list[tuple]]] = [[] for _ in range(window + 1)]
        self.n_open = 0
        self.closed: list[list[tuple]] = []

    def add(self, doc_id: int | None, ids: np.ndarray, start: int = 0, total: int | None = None) -> None:
        total = len(ids) if total is None else total
        whole = len(ids) - len(ids) % self.window
        for at in range(0, whole, self.window):
            self.closed.append([(doc_id, start + at, ids[at : at + self.window], total)])
        if whole < len(ids):
            self._place((doc_id, start + whole, ids[whole:], total), len(ids) - whole)

    def _place(self, piece: tuple, size: int) -> None:
        n = self.levels
        if self.n_open >= self.max_open:
            doc_id, start, ids, total = piece
            gap = self.window - int(np.flatnonzero(n)[-1])  # of the fullest
            if size > gap:
                bin_ = self.open[self.window - gap].pop()
                n[self.window - gap] -= 1
                self.n_open -= 1
                self.closed.append([*bin_, (doc_id, start, ids[:gap], total)])
                piece, size = (doc_id, start + gap, ids[gap:], total), size - gap
        room = self.window - size
        # Change of the sum of squares if a window moves from level h to h + size; level 0 opens one.
        cost = 2 * n[size : self.window + 1] + 1
        cost[room] = 0  # a full window is closed and counts no more
        cost[1:] += np.where(n[1 : room + 1] > 0, 1 - 2 * n[1 : room + 1], np.int64(1) << 60)
        if self.n_open >= self.max_open:  # the fullest has room for it: no new one
            cost[0] = np.int64(1) << 60
        h = room - int(np.argmin(cost[::-1]))
        if h:
            bin_ = self.open[h].pop()
            n[h] -= 1
            self.n_open -= 1
        else:
            bin_ = []
        bin_.append(piece)
        if h + size == self.window:
            self.closed.append(bin_)
            return
        self.open[h + size].append(bin_)
        n[h + size] += 1
        self.n_open += 1

    def run_together(self) -> list[tuple]:
        """Empty the open windows, fullest first, into full ones; returns what is left, less than a window."""
        bin_: list[tuple] = []
        fill = 0
        for level in range(self.window, 0, -1):
            for pieces in self.open[level]:
                for doc_id, start, ids, total in pieces:
                    while len(ids):
                        n = min(len(ids), self.window - fill)
                        bin_.append((doc_id, start, ids[:n], total))
                        start, ids, fill = start + n, ids[n:], fill + n
                        if fill == self.window:
                            self.closed.append(bin_)
                            bin_, fill = [], 0
            self.open[level] = []
        self.levels[:] = 0
        self.n_open = 0
        return bin_

    def take(self) -> list[list[tuple]]:
        out, self.closed = self.closed, []
        return out


def _rows(windows: list[list[tuple]], first: int, keep_ids: bool = False) -> pa.RecordBatch:
    cols: list[list] = [[] for _ in range(8)]
    for k, pieces in enumerate(windows):
        offset = 0
        for doc_id, start, ids, total in pieces:
            raw = ids.astype("<u4").tobytes()
            for col, v in zip(cols, (doc_id, start, len(ids), crc32(raw), total, None if keep_ids else first + k, offset, raw if keep_ids else None), strict=True):
                col.append(v)
            offset += len(ids)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SCHEMA, strict=True)], schema=_SCHEMA)


def _packer(name: str, window: int, end_id: int, max_open: int) -> Callable:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = tokenizer(name), SumOfSquares(window, max_open)
        serial = TaskContext.get().partitionId() << 32
        for batch in sliced(batches, "text", 2 << 20):
            flat, lengths = encoder.encode(batch.column(1).to_pylist())
            at = 0
            for doc_id, n in zip(batch.column(0).to_pylist(), lengths.tolist(), strict=True):
                ids = np.empty(n + 1, np.uint32)
                ids[:n], ids[n] = flat[at : at + n], end_id
                packer.add(doc_id, ids)
                at += n
            done = packer.take()
            if done:
                yield _rows(done, serial)
                serial += len(done)
        tail = packer.run_together()
        done = packer.take()
        if done:
            yield _rows(done, serial)
        if tail:
            yield _rows([tail], 0, keep_ids=True)

    return pack


def _tails(window: int, max_open: int) -> Callable:
    def pack(key: tuple, table: pa.Table) -> pa.Table:
        packer = SumOfSquares(window, max_open)
        table = table.sort_by([("doc_id", "ascending"), ("start", "ascending")])
        for doc_id, start, total, raw in zip(*(table.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")), strict=True):
            packer.add(doc_id, np.frombuffer(raw, "<u4"), start, total)
        last = packer.run_together()
        windows = packer.take() + ([last] if last else [])
        return pa.Table.from_batches([_rows(windows, (1 << 62) + (int(key[0].as_py()) << 32))])

    return pack


def pack(
    docs: DataFrame,
    window: int = WINDOW,
    tokenizer_name: str = TOKENIZER,
    end_id: int = END_ID,
    max_open: int = MAX_OPEN,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """``docs(doc_id, text)`` to one row per piece: where its ids lie in its document and in its sequence.

    Null and empty texts are the end id alone.  Each input row is a document of its own, also when
    rows or ids repeat or doc_id is null.  A document longer than the window, or one that meets the
    end of a tail window, is cut; its ids lie in exactly one piece each.  Only the last window of a
    group of ``fan_in`` tasks is padded, and it is not if its length is a power of two.
    An empty table gives an empty result.
    """
    rows = text_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    packed = write_table(rows.mapInArrow(_packer(tokenizer_name, window, end_id, max_open), _DDL).withColumn("task", F.spark_partition_id()), "packed")
    tails = (
        packed.where("sequence_id IS NULL")
        .withColumn("grp", F.floor(F.col("task") / fan_in))
        .groupBy("grp")
        .applyInArrow(_tails(window, max_open), _DDL)
    )
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return packed.where("sequence_id IS NOT NULL").select(*out).union(tails.select(*out))


def op1_pack_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
