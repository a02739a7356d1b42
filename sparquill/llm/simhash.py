"""SimHash near-dedup with Golay-code fuzzy hashing.

A fingerprint is 64 bits; two are linked when at most four bits differ.  The 64 bits are cut
into segments A (22), B (21) and C (21).  The perfect binary Golay code [23, 12, 7] maps every
23-bit word to the one codeword within three bits; the *codes* of a segment are the codeword
indices of the segment and of its one-bit neighbours (six at most).  Segments at distance two
or less have a neighbour in common, hence a code in common.

Pigeonhole over four errors: either some segment j has no error, and then one of the other two
has at most two (key: codes of i, bits of j); or all have errors, so they are (1,1,1) or (2,1,1)
in some order: with i the worst, j and k have one error each, so one half of j and one half of k
are exact (key: codes of i, a half of j, a half of k).  Every key carries 33 or 34 bits, so a
bucket holds few unrelated fingerprints even in very large corpora.

Only distinct fingerprints are keyed.  Buckets are scanned in key order; every pair of a bucket
is compared (in blocks, skipping what is already connected) and only a spanning forest of the
verified links is emitted, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.llm._runtime import cuts, read, sliced, text_columns, write_table
from sparquill.llm.components import connected_components, joined_with_least

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
#: Generator polynomial of the [23, 12, 7] code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0xAE3
SEGMENTS = ((0, 22), (22, 21), (43, 21))
HALF = 11
#: Characters of a text whose words are held at once.
PIECE = 1 << 20
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


# --- fingerprints ---------------------------------------------------------------------------
def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of the whole text; zero if it has no words.  The words of a long text are held piece by piece."""
    ones, n = np.zeros(64, np.int64), 0
    words: list[bytes] = []
    for piece in cuts(text or "", PIECE):
        words += piece.encode("utf-8", "surrogatepass").translate(_LOWER).split()
        if len(words) >= shingle_words:
            n += _counted(words, shingle_words, ones)
            words = words[len(words) - shingle_words + 1 :]
    if not n and words:
        n = _counted(words, len(words), ones)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _counted(words: list[bytes], k: int, ones: np.ndarray) -> int:
    """Adds the set bits of the hashes of all ``k``-word shingles to ``ones``; how many shingles."""
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - k + 1
    slices = [joined[s:e] for s, e in zip(starts[:n].tolist(), ends[k - 1 :].tolist(), strict=True)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, slices, repeat(SEED)), np.uint64, n)
    for at in range(0, n, 65536):
        block = hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return n


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text"):
        out = np.fromiter(map(fingerprint, batch.column(1).to_pylist()), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, fp)``, one row per input row, no shuffle."""
    return (
        text_columns(docs, "doc_id", "text")
        .select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .mapInArrow(_fingerprints, "doc_id long, fp long")
    )


# --- Golay code -----------------------------------------------------------------------------
@lru_cache(1)
def _golay() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of 12 high bits, and the error pattern (weight at most 3) of each syndrome."""

    def rest(x: int) -> int:
        for bit in range(22, 10, -1):
            if x >> bit & 1:
                x ^= GENERATOR << (bit - 11)
        return x

    high = np.array([rest(v << 11) for v in range(1 << 12)], np.uint32)
    errors = np.zeros(1 << 11, np.uint32)
    single = [rest(1 << b) for b in range(23)]
    for a in range(23):
        errors[single[a]] = 1 << a
        for b in range(a):
            errors[single[a] ^ single[b]] = 1 << a | 1 << b
            for c in range(b):
                errors[single[a] ^ single[b] ^ single[c]] = 1 << a | 1 << b | 1 << c
    return high, errors


def decode(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the nearest codeword of each 23-bit word."""
    high, errors = _golay()
    words = words.astype(np.uint32)
    return (words ^ errors[high[words >> 11] ^ (words & 0x7FF)]) >> 11


def codes(segment: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of the distinct codes of each segment of ``bits`` bits."""
    flips = np.concatenate(([0], 1 << np.arange(bits))).astype(np.uint32)
    all_codes = np.sort(decode(segment.astype(np.uint32)[:, None] ^ flips), axis=1)
    new = np.ones(all_codes.shape, bool)
    new[:, 1:] = all_codes[:, 1:] != all_codes[:, :-1]
    row, col = np.nonzero(new)
    return row, all_codes[row, col].astype(np.int64)


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for unsigned fingerprints; fingerprints within four bits share a key."""
    seg = [((fps >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    halves = [(s & ((1 << HALF) - 1), s >> HALF) for s in seg]
    rows, keys, family = [], [], 0
    for i in range(3):
        row, code = codes(seg[i], SEGMENTS[i][1])
        j, k = (x for x in range(3) if x != i)
        exact = [seg[j], seg[k]] + [a << HALF | b for a in halves[j] for b in halves[k]]
        for bits in exact:
            rows.append(row)
            keys.append((np.int64(family) << 34) | (code << 22) | bits[row])
            family += 1
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        every = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(every), 4096):
            fps = every[at : at + 4096]
            row, key = fuzzy_keys(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fps[row])], names=["key", "fp"])


# --- buckets --------------------------------------------------------------------------------
class _Forest:
    """Union-find over fingerprints seen by a task; ``links`` gets one row per successful union."""

    def __init__(self, most: int = 500_000) -> None:
        self.parent: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []
        self.most = most

    def find(self, x: int) -> int:
        parent, root = self.parent, x
        while (up := parent.get(root, root)) != root:
            root = up
        while (up := parent.get(x, x)) != root:
            parent[x], x = root, up
        return root

    def union(self, a: int, b: int) -> None:
        ra, rb = self.find(a), self.find(b)
        if ra != rb:
            self.parent[max(ra, rb)] = min(ra, rb)
            self.parent.setdefault(min(ra, rb), min(ra, rb))
            self.links.append((a, b))
            if len(self.parent) > self.most:  # forgetting only repeats links
                self.parent = {}


def _scan_group(fps: np.ndarray, forest: _Forest, max_bits: int, block: int = 1024) -> None:
    """Connect what is within ``max_bits`` in one bucket of distinct fingerprints."""
    n = len(fps)
    if n == 2:
        if int(fps[0] ^ fps[1]).bit_count() <= max_bits:
            forest.union(int(fps[0].view(np.int64)), int(fps[1].view(np.int64)))
        return
    ids = fps.view(np.int64).tolist()
    roots = np.array([forest.find(x) for x in ids], np.int64)
    for a in range(0, n, block):
        for b in range(a, n, block):
            left, right = slice(a, min(a + block, n)), slice(b, min(b + block, n))
            while True:
                known = np.unique(np.concatenate((roots[left], roots[right])))
                if len(known) < 2:
                    break
                near = np.bitwise_count(fps[left, None] ^ fps[None, right]) <= max_bits
                near &= roots[left, None] != roots[None, right]
                x, y = np.nonzero(near)
                if not len(x):
                    break
                for p, q in zip(x[:4096].tolist(), y[:4096].tolist(), strict=True):
                    forest.union(ids[a + p], ids[b + q])
                for s in {a: left, b: right}.values():
                    roots[s] = [forest.find(v) for v in ids[s]]


def _linked(max_bits: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest()
        key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)

        def groups(key: np.ndarray, fp: np.ndarray) -> None:
            if not len(key):
                return
            edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
            size = np.diff(edge)
            pair = edge[:-1][size == 2]
            near = np.bitwise_count(fp[pair] ^ fp[pair + 1]) <= max_bits
            signed = fp.view(np.int64)
            for a, b in zip(signed[pair[near]].tolist(), signed[pair[near] + 1].tolist(), strict=True):
                forest.union(a, b)
            for at, n in zip(edge[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
                _scan_group(fp[at : at + n], forest, max_bits)

        def emitted() -> Iterator[pa.RecordBatch]:
            if forest.links:
                pairs = np.array(forest.links, np.int64)
                forest.links = []
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            k = batch.column(0).to_numpy(zero_copy_only=False)
            held.append((k, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
            if k[0] == k[-1] and held[0][0][0] == k[-1]:
                continue  # one bucket, still growing
            key, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = int(np.searchsorted(key, key[-1]))  # the last bucket may go on in the next batch
            groups(key[:cut], fp[:cut])
            held = [(key[cut:], fp[cut:])]
            yield from emitted()
        if held:
            groups(*(np.concatenate(x) for x in zip(*held, strict=True)))
        yield from emitted()

    return scan


def links(distinct_fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(fp)`` distinct to links ``(a, b)`` whose components equal those of all pairs within ``max_bits``."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the keys guarantee four differing bits at most")
    return (
        distinct_fps.select("fp")
        .mapInArrow(_keyed, "key long, fp long")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_linked(max_bits), "a long, b long")
    )


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, fingerprint, component_id, fp)``, one row per input row.

    Null and empty texts have no words and fingerprint zero, linked like any other.  Repeated
    rows each get a row.  Rows with a null doc_id get a fingerprint and join components, but never
    name one unless all rows of the component have none (then component_id is null).  An empty
    table gives an empty result.
    """
    rows = write_table(fingerprints(docs), "fingerprints")
    classes = write_table(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    found = connected_components(links(classes, max_bits))
    labelled = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("component")
    )
    named = joined_with_least(write_table(labelled, "labelled"), "component", "rep", "component_id").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
