"""Edit-aware token counts: a segment tree over each document's pre-token segments.

A document is cut at blanks and line ends into segments of about :data:`SEGMENT` characters.  No
pre-token spans white space, so the token count of a document is the sum over its segments, and an
edit can only change segments that it touches; where it reaches a segment's end, the neighbour is
the boundary context and joins the region.  The tree keeps characters and tokens per node: an edit
descends by characters to its segments, re-encodes that region alone and adds the differences on
the way to the root.  A region that has grown is cut again and the tree rebuilt over counts, without
encoding anything else.

Trees are kept: :func:`count_trees` writes a table of texts with their trees, :func:`edited` applies
edits to such a table and returns the next one, and only what the edits touch is ever encoded again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.llm._runtime import read, sliced, text_columns, write_table
from sparquill.llm.tokens import TOKENIZER, CachedTokenizer, tokenizer

SEGMENT = 512
_BREAK = re.compile("[ \n]")


def segments_of(text: str, size: int = SEGMENT) -> list[str]:
    """The text in pieces of ``size`` characters or more that end with a blank or line end (the last may not)."""
    out, at = [], 0
    while at < len(text):
        m = _BREAK.search(text, at + size - 1)
        end = m.end() if m else len(text)
        out.append(text[at:end])
        at = end
    return out or [""]


class CountTree:
    """Characters and tokens of a document's segments, with subtree sums."""

    def __init__(self, segments: list[str], tokens: list[int], encoder: CachedTokenizer, size: int = SEGMENT) -> None:
        self.encoder, self.size = encoder, size
        self.segments, self.encoded_chars = segments, 0
        self._build(tokens)

    @classmethod
    def kept(cls, text: str, tree: bytes, encoder: CachedTokenizer, size: int = SEGMENT) -> CountTree:
        """The tree that :meth:`state` wrote, over its text; nothing is encoded."""
        self = cls.__new__(cls)
        self.encoder, self.size, self.encoded_chars = encoder, size, 0
        n = int.from_bytes(tree[:4], "little")
        self.sums = np.frombuffer(tree, "<u4", offset=4).reshape(-1, 2).astype(np.int64)
        self.leaves = len(self.sums) // 2
        ends = list(accumulate(self.sums[self.leaves : self.leaves + n, 0].tolist()))
        self.segments = [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        return self

    def state(self) -> bytes:
        """Number of segments and the sums of all nodes, little-endian uint32."""
        return len(self.segments).to_bytes(4, "little") + self.sums.astype("<u4").tobytes()

    def _build(self, tokens: list[int]) -> None:
        n = len(self.segments)
        self.leaves = 1 << max(0, n - 1).bit_length()
        self.sums = np.zeros((2 * self.leaves, 2), np.int64)
        self.sums[self.leaves : self.leaves + n, 0] = [len(s) for s in self.segments]
        self.sums[self.leaves : self.leaves + n, 1] = tokens
        width = self.leaves
        while width > 1:
            half = width // 2
            np.add(self.sums[width : 2 * width : 2], self.sums[width + 1 : 2 * width : 2], out=self.sums[half:width])
            width = half

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1, 1])

    @property
    def n_chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def text(self) -> str:
        return "".join(self.segments)

    def _find(self, pos: int) -> tuple[int, int]:
        """Segment that holds character ``pos`` (the last one for the end) and its first character."""
        node, start = 1, 0
        while node < self.leaves:
            node *= 2
            if pos >= start + self.sums[node, 0] and self.sums[node + 1, 0]:
                start += int(self.sums[node, 0])
                node += 1
        return node - self.leaves, start

    def edit(self, start: int, removed: int, inserted: str) -> None:
        """Replace ``removed`` characters from ``start`` by ``inserted``; positions beyond the text are clipped."""
        start = min(max(start, 0), self.n_chars)
        end = min(start + max(removed, 0), self.n_chars)
        first, at = self._find(start)
        if first and start == at:  # what goes before may now continue the segment before
            first -= 1
            at -= len(self.segments[first])
        last, last_at = self._find(end)
        region = "".join(self.segments[first : last + 1])
        region = region[: start - at] + inserted + region[end - at :]
        while last + 1 < len(self.segments) and region[-1:] not in (" ", "\n"):  # the context after it
            last += 1
            region += self.segments[last]
        pieces = segments_of(region, self.size)
        counts = self.encoder.counts(pieces)
        self.encoded_chars += len(region)
        if len(pieces) == last + 1 - first:
            for k, (piece, n) in enumerate(zip(pieces, counts.tolist(), strict=True), first):
                self.segments[k] = piece
                node = self.leaves + k
                path = [node >> up for up in range(node.bit_length())]  # to the root
                self.sums[path] += np.array((len(piece), n)) - self.sums[node]
            return
        tokens = self.sums[self.leaves : self.leaves + len(self.segments), 1].tolist()
        tokens[first : last + 1] = counts.tolist()
        self.segments[first : last + 1] = pieces
        self._build(tokens)


_EDITS = "array<struct<start:long,removed:long,inserted:string>>"


def with_edits(kept: DataFrame, edits: DataFrame) -> DataFrame:
    """A table of trees with its edits ``(doc_id, seq, start, removed, inserted)`` in order of ``seq``.

    Edits with a null doc_id or of no document go; rows that share a doc_id all get its edits; rows
    without edits get null.  The edits of one document go to one task, which applies them in turn.
    """
    lists = (
        text_columns(edits, "doc_id", "seq", "start", "removed", "inserted")
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_list(F.struct("seq", "start", "removed", "inserted"))).alias("edits"))
        .withColumn("edits", F.transform("edits", lambda e: F.struct(e["start"].cast("long").alias("start"), e["removed"].cast("long").alias("removed"), e["inserted"].alias("inserted"))))
    )
    return text_columns(kept, "doc_id", "text", "tree").join(lists, "doc_id", "left")


def count_trees(docs: DataFrame, tokenizer_name: str = TOKENIZER, size: int = SEGMENT) -> DataFrame:
    """``docs(doc_id, text)`` to the kept table ``(doc_id, text, tree)``, one row per input row.

    Null texts become empty.  Repeated rows and null ids each keep a tree of their own; extra columns are
    left out; an empty table gives an empty one.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(tokenizer_name)
        for batch in sliced(batches, "text", 2 << 20):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            parts = [segments_of(t, size) for t in texts]
            counts = encoder.counts([s for p in parts for s in p]).tolist()
            trees, at = [], 0
            for part in parts:
                trees.append(CountTree(part, counts[at : at + len(part)], encoder, size).state())
                at += len(part)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(trees, pa.binary())], names=["doc_id", "text", "tree"])

    rows = text_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return write_table(rows.mapInArrow(scan, "doc_id long, text string, tree binary"), "trees")


_EDITED = "n_segments long, tokens_before long, tokens_after long, chars_after long, chars_encoded_again long"


def edited(kept: DataFrame, tokenizer_name: str = TOKENIZER, size: int = SEGMENT) -> DataFrame:
    """``kept(doc_id, text, tree, edits)`` to ``(doc_id, text, tree)`` after the edits, and the counts, one row per input row.

    Edits apply one after another, each to the text as the earlier ones left it, positions in code points.
    Null edits are none; null fields of an edit are 0 or empty.  The counts equal those of encoding the
    whole text before and after: tokens_before, tokens_after; n_segments and chars_after are after the
    edits, chars_encoded_again is what was encoded.  The result can be kept and edited again.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(tokenizer_name)
        for batch in sliced(batches, "text", 2 << 20):
            cols: list[list] = [[], [], [], [], [], [], []]
            for text, state, edits in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                tree = CountTree.kept(text, state, encoder, size)
                before = tree.n_tokens
                for e in edits or ():
                    tree.edit(e["start"] or 0, e["removed"] or 0, e["inserted"] or "")
                row = (tree.text, tree.state(), len(tree.segments), before, tree.n_tokens, tree.n_chars, tree.encoded_chars) if edits else (text, state, len(tree.segments), before, before, tree.n_chars, 0)
                for col, v in zip(cols, row, strict=True):
                    col.append(v)
            kinds = (pa.string(), pa.binary(), *[pa.int64()] * 5)
            names = ["doc_id", "text", "tree", "n_segments", "tokens_before", "tokens_after", "chars_after", "chars_encoded_again"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=names)

    rows = kept.select(F.col("doc_id").cast("long"), "text", "tree", F.col("edits").cast(_EDITS))
    return rows.mapInArrow(scan, f"doc_id long, text string, tree binary, {_EDITED}")


def drill(docs: DataFrame) -> DataFrame:
    """Three edits for every document, fixed by its id and length: an insertion, a deletion, a replacement."""
    at = lambda k: F.pmod(F.xxhash64("doc_id", F.lit(k)), F.coalesce(F.length("text"), F.lit(0)) + 1)
    word = F.concat(F.lit("ed"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("it "))
    edit = lambda k, n, s: F.struct(at(k).alias("start"), F.lit(n).cast("long").alias("removed"), s.alias("inserted"))
    return docs.withColumn("edits", F.array(edit(1, 0, word), edit(2, 9, F.lit("")), edit(3, 5, F.lit("new, text"))))


def op4_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited(drill(count_trees(read(spark, sf_dir, "documents")))).drop("text", "tree")
