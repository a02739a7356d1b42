"""Exact removal of repeated byte strings by logarithmic families of suffix arrays.

A string of ``width`` (50) bytes that also starts in a document with a smaller id is removed.  The
suffix space is split by content: in each string the k-gram of ``K`` bytes with the smallest hash
(leftmost on ties) is its anchor, so equal strings have equal anchors, and neighbouring strings
mostly share one.  A run of strings with one anchor is a *super string*; all strings of a super string
belong to the bucket of its anchor.

1. Documents are written as compressed segments.  Every segment sends the hashes of its anchors,
   once each, to their buckets and learns which of them occur in another document.
2. Super strings of those anchors go to the buckets, equal ones of a segment once, with the smallest
   id.  A bucket takes its strings in batches by ascending document.  Each batch gets a suffix array
   (suffixes cut at ``width``, in the order of their bytes), is merge-scanned against the existing levels
   for the first document of each string, and what it has anew becomes a level; levels of equal size
   merge geometrically.  Strings are equal if their bytes are.
3. Segments get back, per super string, its first document and which of its strings occur in a still
   smaller one, and cut the bytes out.

A hot passage is one entry per segment in steps 1 and 2, whatever the number of its copies.

:class:`SuffixFamily` keeps the same structure between batches of documents: every batch leaves a level
(its segments and their anchors, as tables in the shared folder), a later batch is scanned against all
levels without taking their texts apart again, and levels of equal size merge.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.llm._runtime import drop_table, read, sliced, text_columns, write_table

WIDTH = 50
K = 20
SEGMENT_BYTES = 4 << 20
#: Anchors per bucket aimed at, and strings of one suffix array batch.
BUCKET_ANCHORS = 1 << 18
BATCH = 1 << 17
_NULL_ID = np.iinfo(np.int64).max
_CHUNK = 1 << 18


# --- anchors --------------------------------------------------------------------------------
def _words(raw: np.ndarray, n: int) -> np.ndarray:
    """Little-endian 64-bit words starting at each of the first ``n`` bytes."""
    padded = np.concatenate((raw, np.zeros(8, np.uint8)))
    return np.lib.stride_tricks.as_strided(padded, (n, 8), (1, 1)).copy().view("<u8").ravel()


def _mix(h: np.ndarray, v: np.ndarray, mul: int) -> np.ndarray:
    h = (h + v) * np.uint64(mul)
    h ^= h >> np.uint64(29)
    return h


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    n = len(raw) - K + 1
    v = _words(raw, len(raw) - 7)
    h = _mix(np.zeros(n, np.uint64), v[:n], 0x9E3779B97F4A7C15)
    h = _mix(h, v[8 : 8 + n], 0xBF58476D1CE4E5B9)
    return _mix(h, v[K - 8 : K - 8 + n], 0x94D049BB133111EB)


def runs(raw: np.ndarray, ends: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Super strings of documents in a row that end at ``ends``: (first string, number of strings, document, anchor hash).

    Works through the bytes in chunks; a super string that meets a chunk's end is two, which changes no match.
    """
    n, w = len(raw) - width + 1, width - K + 1
    low = np.uint64((1 << 24) - 1)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, n, _CHUNK):
        size = min(_CHUNK, n - at)
        hashes = gram_hashes(raw[at : at + size + width - 1])
        key = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)  # smallest hash, then leftmost
        span = 1
        while span * 2 <= w:
            key = np.minimum(key[:-span], key[span:])
            span *= 2
        if w > span:
            key = np.minimum(key[: len(key) - (w - span)], key[w - span :])
        anchor = (key & low).astype(np.int32)
        valid = np.ones(size, bool)
        lo, hi = np.searchsorted(ends, [at, at + size + width])
        for end in ends[lo:hi].tolist():  # strings that would cross into the next document
            valid[max(0, end - width + 1 - at) : max(0, end - at)] = False
        new = np.ones(size, bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | ~valid[:-1]
        start = np.flatnonzero(new & valid)
        stop = np.flatnonzero(valid & np.concatenate((new[1:] | ~valid[1:], [True]))) + 1
        # Anchors are minima, so their hashes are mixed again before buckets are taken from the high bits.
        again = hashes[anchor[start]] * np.uint64(0xD6E8FEB86659FD93)
        again = (again ^ (again >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        out.append((start + at, stop - start, np.searchsorted(ends, start + at, side="right"), again))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Segment:
    """Documents in a row; ``runs`` are the super strings."""

    def __init__(self, ids: bytes, lengths: bytes, blob: bytes, width: int = WIDTH) -> None:
        self.ids, self.lengths, self.width = np.frombuffer(ids, "<i8"), np.frombuffer(lengths, "<i8"), width
        self.raw = zstandard.ZstdDecompressor().decompress(blob, max_output_size=max(1, int(self.lengths.sum())))
        self.ends = np.cumsum(self.lengths)
        self.bytes = np.frombuffer(self.raw, np.uint8)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return runs(self.bytes, self.ends, self.width)


def _segmented(since: int):
    """Segments of documents, numbered from ``since`` on by task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, packer = since + (TaskContext.get().partitionId() << 24), zstandard.ZstdCompressor(3)
        ids: list[int] = []
        texts: list[bytes] = []
        held = 0

        def row() -> pa.RecordBatch:
            blob = packer.compress(b"".join(texts))
            lengths = np.array([len(t) for t in texts], "<i8")
            cols = [pa.array([seg]), pa.array([int(lengths.sum())]), *(pa.array([x], pa.binary()) for x in (np.array(ids, "<i8").tobytes(), lengths.tobytes(), blob))]
            return pa.RecordBatch.from_arrays(cols, names=["seg", "n_bytes", "ids", "lengths", "blob"])

        for batch in sliced(batches, "text", SEGMENT_BYTES):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                if ids and held + len(raw) > SEGMENT_BYTES:
                    yield row()
                    seg, ids, texts, held = seg + 1, [], [], 0
                ids.append(_NULL_ID if doc_id is None else doc_id)
                texts.append(raw)
                held += len(raw)
        if ids:
            yield row()

    return scan


# --- step 1: anchors in several documents ----------------------------------------------------
def _bucketed(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of sorted hashes: (bucket numbers, bounds)."""
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    heads = np.flatnonzero(np.diff(bucket, prepend=-1))
    return bucket[heads], np.append(heads, len(hashes))


def _short(hashes: np.ndarray, bits: int) -> bytes:
    """The 40 bits below the bucket's; different anchors that agree in them only cost work."""
    part = (hashes << np.uint64(bits)) >> np.uint64(24)
    return part.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _distinct(seg: Segment) -> tuple[tuple, np.ndarray, np.ndarray, np.ndarray]:
    """Runs; distinct anchor hashes ascending; whether several rows hold them; place of each run's hash."""
    runs = seg.runs()
    values, place = np.unique(runs[3], return_inverse=True)
    first, last = np.full(len(values), _NULL_ID), np.full(len(values), -1)
    np.minimum.at(first, place, runs[2])
    np.maximum.at(last, place, runs[2])
    return runs, values, first != last, place


def _announce(bits: int, width: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                seg, ids, lengths, blob = (batch.column(c)[k].as_py() for c in range(4))
                _, values, several, _ = _distinct(Segment(ids, lengths, blob, width))
                buckets, bounds = _bucketed(values, bits)
                parts = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets), pa.array(np.full(len(buckets), seg)), pa.array([_short(values[a:b], bits) for a, b in parts], pa.binary()), pa.array([np.packbits(several[a:b]).tobytes() for a, b in parts], pa.binary())],
                    names=["bucket", "seg", "grams", "several"],
                )

    return scan


def _shared(key: tuple, table: pa.Table) -> pa.Table:
    """Flags of each segment's anchors in this bucket: whether a new row holds them, and another row as well."""
    segs, grams, several = (table.column(c).to_pylist() for c in ("seg", "grams", "several"))
    sizes = np.array([len(g) // 5 for g in grams])
    wide = np.zeros((int(sizes.sum()), 8), np.uint8)
    wide[:, :5] = np.frombuffer(b"".join(grams), np.uint8).reshape(-1, 5)
    values = wide.view("<u8").ravel()
    many = np.concatenate([np.unpackbits(np.frombuffer(s, np.uint8), count=n) for s, n in zip(several, sizes.tolist(), strict=True)]).astype(bool)
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    same = np.concatenate(([False], ordered[1:] == ordered[:-1], [False]))
    many[order] |= same[:-1] | same[1:]
    fresh = np.repeat(table.column("fresh").to_numpy(zero_copy_only=False), sizes)[order]
    group = np.cumsum(~same[:-1]) - 1
    many[order] &= (np.bincount(group, fresh) > 0)[group] if len(group) else False
    bounds = np.concatenate(([0], np.cumsum(sizes))).tolist()
    rows = [(s, np.packbits(many[a:b]).tobytes()) for s, a, b in zip(segs, bounds, bounds[1:], strict=False) if many[a:b].any()]
    # Anchors that look alike in 40 bits within a segment are flagged too: they only cost work.
    return pa.table({"seg": pa.array([r[0] for r in rows], pa.int64()), "bucket": pa.array([key[0].as_py()] * len(rows), pa.int64()), "flags": pa.array([r[1] for r in rows], pa.binary())})


# --- step 2: families of suffix arrays -------------------------------------------------------
class LevelFamily:
    """Suffix arrays of geometrically growing sizes: distinct strings in byte order, each with its smallest document."""

    def __init__(self, base: int = BATCH) -> None:
        self.base = base
        self.levels: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def take(self, strings: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Smallest document so far of each string of a batch, the batch included; the batch joins the family."""
        order = np.argsort(strings, kind="stable")
        ordered = strings[order]
        heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        own, least = ordered[heads], np.minimum.reduceat(doc[order], heads)
        new = np.ones(len(own), bool)
        for held, first in self.levels.values():  # both sides are in byte order
            at = np.minimum(np.searchsorted(held, own), len(held) - 1)
            hit = held[at] == own
            least = np.where(hit, np.minimum(least, first[at]), least)
            np.minimum.at(first, at[hit], least[hit])
            new &= ~hit
        out = np.empty(len(strings), np.int64)
        out[order] = np.repeat(least, np.diff(np.append(heads, len(strings))))
        if new.any():
            self._insert(own[new], least[new])
        return out

    def _insert(self, own: np.ndarray, least: np.ndarray) -> None:
        while True:
            size = max(0, (len(own) - 1) // self.base).bit_length()
            if size not in self.levels:
                self.levels[size] = own, least
                return
            held, first = self.levels.pop(size)
            own, least = np.concatenate((held, own)), np.concatenate((first, least))
            order = np.argsort(own, kind="stable")  # two sorted runs without a common string: a merge
            own, least = own[order], least[order]


def _strings(raw: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` bytes from each place on, as strings that compare by their bytes."""
    rows = np.lib.stride_tricks.as_strided(raw, (len(raw) - width + 1, width), (1, 1), writeable=False)
    return np.ascontiguousarray(rows[at]).view(f"S{width}").ravel()


def _alike(raw: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Group number of each stretch of bytes; equal stretches have equal numbers."""
    most = int(length.max())
    padded = np.concatenate((raw, np.zeros(most, np.uint8)))
    rows = np.lib.stride_tricks.as_strided(padded, (len(raw) + 1, most), (1, 1), writeable=False)[begin]
    rows[np.arange(most) >= length[:, None]] = 0
    strings = np.ascontiguousarray(rows).view(f"S{most}").ravel()
    order = np.argsort(length, kind="stable")
    order = order[np.argsort(strings[order], kind="stable")]  # by bytes, then length: padding can't be taken for zeros
    new = np.ones(len(order), bool)
    new[1:] = (strings[order[1:]] != strings[order[:-1]]) | (length[order[1:]] != length[order[:-1]])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return group


def _offer(bits: int, width: int, since: int):
    """Super strings of flagged anchors by bucket, and where they occur in each segment from ``since`` on (bucket below 0)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(3)
        for batch in batches:
            for row in range(batch.num_rows):
                number, ids, lengths, blob, flags = (batch.column(c)[row].as_py() for c in range(5))
                seg = Segment(ids, lengths, blob, width)
                (start, size, doc, _), values, _, place = _distinct(seg)
                buckets, bounds = _bucketed(values, bits)
                flagged = np.zeros(len(values), bool)
                where = dict(zip(buckets.tolist(), range(len(buckets)), strict=True))
                for f in flags:
                    k = where[f["bucket"]]
                    flagged[bounds[k] : bounds[k + 1]] = np.unpackbits(np.frombuffer(f["flags"], np.uint8), count=int(bounds[k + 1] - bounds[k]))
                keep = np.flatnonzero(flagged[place])
                keep = keep[np.argsort(place[keep], kind="stable")]
                owner = np.searchsorted(bounds, place[keep], side="right") - 1
                docs = seg.ids[doc[keep]].tolist()
                spans = zip(start[keep].tolist(), (start[keep] + size[keep] + width - 1).tolist(), docs, owner.tolist(), strict=True)
                index: dict[bytes, int] = {}
                first: list[int] = []
                home: list[int] = []
                ordinal = np.empty(len(keep), np.int64)
                for k, (a, b, d, o) in enumerate(spans):
                    s = seg.raw[a:b]
                    n = index.setdefault(s, len(first))
                    if n == len(first):
                        first.append(d)
                        home.append(o)
                    elif d < first[n]:
                        first[n] = d
                    ordinal[k] = n
                strings = list(index)
                at = np.searchsorted(np.array(home, np.int64), np.arange(len(buckets) + 1)).tolist()
                cols: list[list] = [[], [], [], [], []]
                for k, bucket in enumerate(buckets.tolist()):
                    a, b = at[k], at[k + 1]
                    if a < b:
                        lens = np.array([len(s) - width + 1 for s in strings[a:b]], np.uint8)
                        for col, v in zip(cols, (bucket, number, lens.tobytes(), packer.compress(b"".join(strings[a:b])), np.array(first[a:b], "<i8").tobytes()), strict=True):
                            col.append(v)
                if number >= since:
                    places = np.stack((start[keep], size[keep], ordinal)).astype("<u4").tobytes()
                    for col, v in zip(cols, (-1 - number, number, None, packer.compress(places), None), strict=True):
                        col.append(v)
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["bucket", "seg", "sizes", "strings", "docs"])

    return scan


def _resolve(width: int, base: int, since: int):
    """First document of each super string, and the strings of it that a still smaller document has; answers for segments from ``since`` on."""
    out = pa.schema([("seg", pa.int64()), ("bucket", pa.int64()), ("firsts", pa.binary()), ("masks", pa.binary())])

    def resolve(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        if bucket < 0:  # places of a segment pass through
            return pa.table([table.column("seg"), table.column("bucket"), table.column("strings"), pa.nulls(table.num_rows, pa.binary())], schema=out)
        table = table.sort_by("seg")
        unpack = zstandard.ZstdDecompressor()
        segs = table.column("seg").to_pylist()
        sizes = [np.frombuffer(s, np.uint8).astype(np.int64) for s in table.column("sizes").to_pylist()]
        text = np.frombuffer(b"".join(unpack.decompress(s) for s in table.column("strings").to_pylist()), np.uint8)
        doc = np.frombuffer(b"".join(table.column("docs").to_pylist()), "<i8")
        table = None
        size = np.concatenate(sizes)
        begin = np.cumsum(size + width - 1) - (size + width - 1)
        # Strings by ascending document: what a batch meets in the levels is from documents no larger.
        rank = np.argsort(doc, kind="stable")
        of = np.repeat(rank, size[rank])
        step = np.arange(len(of)) - np.repeat(np.cumsum(size[rank]) - size[rank], size[rank])
        # Sub-families by the strings' ends bound the sorted arrays, whatever the bucket's size.
        parts = max(1, -(-len(of) // (4 * base)))
        first = np.empty(len(of), np.int64)
        if parts > 1:
            part = np.empty(len(of), np.uint16 if parts < 1 << 16 else np.uint32)
            for a in range(0, len(of), base):
                at = begin[of[a : a + base]] + step[a : a + base]
                ends = np.zeros(len(at), np.uint64)
                for k in (*range(4), *range(width - 4, width)):
                    ends = (ends + text[at + k]) * np.uint64(0x9E3779B97F4A7C15)
                part[a : a + base] = (ends >> np.uint64(32)) % np.uint64(parts)
        for p in range(parts):
            rows = np.flatnonzero(part == p) if parts > 1 else np.arange(len(of))
            family = LevelFamily(base)
            for a in range(0, len(rows), base):
                own = rows[a : a + base]
                first[own] = family.take(_strings(text, begin[of[own]] + step[own], width), doc[of[own]])
        # Equal super strings of different segments: the first document of all is that of the whole string.
        group = _alike(text, begin, size + width - 1)
        least = np.full(int(group.max()) + 1, _NULL_ID)
        np.minimum.at(least, group, doc)
        start = least[group]
        mask = np.zeros(len(size), np.uint32)
        earlier = first < start[of]
        np.bitwise_or.at(mask, of[earlier], np.uint32(1) << step[earlier].astype(np.uint32))
        bounds = np.concatenate(([0], np.cumsum([len(s) for s in sizes]))).tolist()
        rows = [r for r in zip(segs, bounds, bounds[1:], strict=False) if r[0] >= since]
        return pa.table([[r[0] for r in rows], [bucket] * len(rows), [start[a:b].astype("<i8").tobytes() for _, a, b in rows], [mask[a:b].astype("<u4").tobytes() for _, a, b in rows]], schema=out)

    return resolve


# --- step 3: cutting ------------------------------------------------------------------------
def _cut(width: int, keep_text: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in range(batch.num_rows):
                ids, lengths, blob, found = (batch.column(c)[row].as_py() for c in range(1, 5))
                seg = Segment(ids, lengths, blob, width)
                delta = np.zeros(len(seg.raw) + 1, np.int64)
                if found:
                    found = sorted(found, key=lambda f: f["bucket"])
                    start, size, ordinal = np.frombuffer(unpack.decompress(found[0]["firsts"]), "<u4").reshape(3, -1).astype(np.int64)
                    first = np.frombuffer(b"".join(f["firsts"] for f in found[1:]), "<i8")
                    mask = np.frombuffer(b"".join(f["masks"] for f in found[1:]), "<u4")
                    own = seg.ids[np.searchsorted(seg.ends, start, side="right")]
                    later = own > first[ordinal]
                    np.add.at(delta, start[later], 1)
                    np.subtract.at(delta, start[later] + size[later] + width - 1, 1)
                    some = np.flatnonzero(~later & (mask[ordinal] > 0))
                    for k in range(width - K + 1):
                        at = start[some][mask[ordinal[some]] >> np.uint32(k) & np.uint32(1) > 0] + k
                        np.add.at(delta, at, 1)
                        np.subtract.at(delta, at + width, 1)
                gone = np.cumsum(delta[:-1]) > 0
                cols: list[list] = [[], [], [], [], [], []]
                begin = 0
                for doc_id, end in zip(seg.ids.tolist(), seg.ends.tolist(), strict=True):
                    g = gone[begin:end]
                    n = int(np.count_nonzero(g))
                    spans = int(np.count_nonzero(g[1:] & ~g[:-1]) + g[0]) if n else 0
                    rest = seg.bytes[begin:end][~g].tobytes() if n else seg.raw[begin:end]
                    for col, v in zip(cols, (None if doc_id == _NULL_ID else doc_id, end - begin, n, spans, hashlib.sha256(rest).hexdigest(), rest if keep_text else None), strict=True):
                        col.append(v)
                    begin = end
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "rest"])

    return scan


class SuffixFamily:
    """Levels that earlier batches of documents left: (segments, their anchors, bucket bits of those, bytes).

    A level's tables lie in the shared folder.  Sizes of levels are powers of two of ``base`` bytes apart;
    two of one size merge into one of the next, so there are logarithmically many.
    """

    def __init__(self, width: int = WIDTH, base: int = 64 << 20) -> None:
        self.width, self.base = width, base
        self.batches = 0
        self.levels: dict[int, tuple[DataFrame, DataFrame, int, int]] = {}

    @property
    def n_bytes(self) -> int:
        return sum(level[3] for level in self.levels.values())

    def anchors(self, bits: int) -> list[DataFrame]:
        """Anchors of every level by buckets of ``bits``; a level that has them by other buckets makes them anew."""
        return [a if b == bits else s.select(*_SEGMENT).mapInArrow(_announce(bits, self.width), _ANCHORS) for s, a, b, _ in self.levels.values()]

    def insert(self, segments: DataFrame, anchors: DataFrame, bits: int, n_bytes: int) -> None:
        self.batches += 1
        while True:
            size = max(0, (n_bytes - 1) // self.base).bit_length()
            if size not in self.levels:
                self.levels[size] = segments, anchors, bits, n_bytes
                return
            old = self.levels.pop(size)
            both = write_table(old[0].unionByName(segments), "segments")
            near = old[1] if old[2] == bits else old[0].select(*_SEGMENT).mapInArrow(_announce(bits, self.width), _ANCHORS)
            named = write_table(near.unionByName(anchors), "anchors")
            for table in (old[0], segments, old[1], anchors):
                drop_table(table)
            segments, anchors, n_bytes = both, named, n_bytes + old[3]


_SEGMENT = ("seg", "ids", "lengths", "blob")
_ANCHORS = "bucket long, seg long, grams binary, several binary"


def remove_repeats(docs: DataFrame, width: int = WIDTH, keep_text: bool = False, family: SuffixFamily | None = None) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, rest)``, one row per input row.

    Every byte covered by a ``width``-byte string that also starts in a document with a smaller id is
    removed; strings are judged on the input and never cross documents.  ``rest`` (with ``keep_text``)
    holds the remaining bytes, which may cut a character.  Null texts are empty.  Rows of one id lose
    nothing to each other; rows with a null id count as larger than all ids.  Extra columns are ignored; an
    empty table gives an empty result.  ``width`` is 28 to 51.

    With a ``family``, documents of its earlier batches count as well (their own results stay as they
    were given), and this batch becomes a level of it.  Batches in order of their ids together give the
    same rows as one batch of all.
    """
    if not K + 8 <= width <= K + 31:
        raise ValueError(f"width must lie in {K + 8}..{K + 31}")
    if family is not None and family.width != width:
        raise ValueError("the family holds strings of another width")
    since = (family.batches if family else 0) << 48
    rows = text_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    segments = write_table(rows.mapInArrow(_segmented(since), "seg long, n_bytes long, ids binary, lengths binary, blob binary"), "segments")
    own = segments.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n")).first()["n"]
    total = own + (family.n_bytes if family else 0)
    bits = max(0, (total // 16 // BUCKET_ANCHORS).bit_length())
    base = segments.select(*_SEGMENT)
    anchors = base.mapInArrow(_announce(bits, width), _ANCHORS)
    named, every = anchors.withColumn("fresh", F.lit(True)), base
    if family is not None:
        anchors = write_table(anchors, "anchors")
        named = anchors.withColumn("fresh", F.lit(True))
        for level in family.anchors(bits):
            named = named.unionByName(level.withColumn("fresh", F.lit(False)))
        for level in family.levels.values():
            every = every.unionByName(level[0].select(*_SEGMENT))
    flags = write_table(named.groupBy("bucket").applyInArrow(_shared, "seg long, bucket long, flags binary"), "flags")
    by_segment = flags.groupBy("seg").agg(F.collect_list(F.struct("bucket", "flags")).alias("flags"))
    found = write_table(
        every.join(by_segment, "seg")
        .select(*_SEGMENT, "flags")
        .mapInArrow(_offer(bits, width, since), "bucket long, seg long, sizes binary, strings binary, docs binary")
        .groupBy("bucket")
        .applyInArrow(_resolve(width, BATCH, since), "seg long, bucket long, firsts binary, masks binary"),
        "firsts",
    )
    drop_table(flags)
    answers = found.groupBy("seg").agg(F.collect_list(F.struct("bucket", "firsts", "masks")).alias("found"))
    cut = base.join(answers, "seg", "left").select(*_SEGMENT, "found").mapInArrow(
        _cut(width, keep_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, rest binary"
    )
    if family is not None:  # the level may be merged and its tables deleted before the result is read
        cut = write_table(cut, "cut")
        family.insert(segments, anchors, bits, own)
    return cut


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).drop("rest")


OP6_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), w AS (
  SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 100)) AS k FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM d WHERE n >= 50)
), f AS (SELECT k, min(doc_id) AS first_doc FROM w GROUP BY k
), hit AS (SELECT w.doc_id, w.i FROM w JOIN f USING (k) WHERE f.first_doc < w.doc_id
), run AS (
  SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50, -1) AS fresh FROM hit
), span AS (
  SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM (SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM run) GROUP BY doc_id, g
), gap AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM span
), rest AS (
  SELECT g.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last_b, string_agg(substr(h, (2 * p + 1)::BIGINT, (2 * (a - p))::BIGINT), '' ORDER BY a) AS kept
  FROM gap g JOIN d ON g.doc_id = d.doc_id GROUP BY g.doc_id
)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN kept IS NULL THEN h ELSE kept || substr(h, (2 * last_b + 1)::BIGINT) END)) AS kept_sha256
FROM d LEFT JOIN rest ON d.doc_id = rest.doc_id
"""
