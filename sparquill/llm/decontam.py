"""Benchmark decontamination over a stored, document-partitioned positional inverted index.

Documents are indexed in blocks of about :data:`BLOCK_BYTES`: a block's row holds its terms, the sorted
positions of each, and where its documents begin.  The index knows nothing of the test side, is written
once to the shared folder, and serves any number of searches (:func:`build_index`).

A test window (8 consecutive words) starts from the shortest of its terms' posting lists, shifts it by
the term's offset and intersects it with the other lists, shortest first; what remains are exact
occurrences.  Windows are taken in groups whose lists are bounded together, so memory does not grow with
windows times positions.  The test side goes to the tasks in chunks of checked size; a larger test side
takes one pass over the index per chunk, and only the occurrences of the passes are brought together.
Neither texts nor postings are ever shuffled in a single pass; a block is at home in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.llm._runtime import cuts, read, sliced, text_columns, write_table

WINDOW_WORDS = 8
MIN_ITEMS = 2
#: Bytes of text in a block (a longer text is a block of its own).
BLOCK_BYTES = 4 << 20
#: Bytes of test text in one chunk, the bound of what a pass sends to the tasks.
CHUNK_BYTES = 16 << 20
#: Positions that are intersected at once (one window's shortest list at least).
EXPANDED = 1 << 20
#: A-Z lowered; bytes outside [0-9a-z] and UTF-8's high bytes become separators.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


class Phrases:
    """Test windows as rows of term ids, padded with -1, and the items each window belongs to."""

    def __init__(self, items: Iterable[tuple[int, str | None]], size: int = WINDOW_WORDS) -> None:
        self.vocab: dict[bytes, int] = {}
        rows: dict[tuple[int, ...], set[int]] = {}
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words_of(text)]
            for at in range(max(1, len(ids) - size + 1) if ids else 0):
                rows.setdefault(tuple(ids[at : at + size]), set()).add(item)
        self.windows = np.full((len(rows), size), -1, np.int64)
        for k, row in enumerate(rows):
            self.windows[k, : len(row)] = row
        self.sizes = (self.windows >= 0).sum(axis=1)
        self.item_ends = np.cumsum([0, *map(len, rows.values())])
        self.items = np.array([i for s in rows.values() for i in sorted(s)], np.int64)


# --- the index ------------------------------------------------------------------------------
_INDEX_DDL = "block long, doc_ids binary, n_words binary, terms binary, counts binary, positions binary, rows binary"


def _posted(texts: list[str | None]) -> tuple[np.ndarray, bytes, np.ndarray, np.ndarray]:
    """(words per text, terms in a row, list lengths, positions of the lists in a row) of texts one after another."""
    vocab: dict[bytes, int] = {}
    parts, n_words = [], np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        for piece in cuts(text) if text else ():
            own = words_of(piece)
            for w in dict.fromkeys(own):
                vocab.setdefault(w, len(vocab))
            parts.append(np.fromiter(map(vocab.__getitem__, own), np.int32, len(own)))
            n_words[k] += len(own)
    stream = np.concatenate(parts) if parts else np.empty(0, np.int32)
    return n_words, b" ".join(vocab), np.bincount(stream, minlength=len(vocab)), np.argsort(stream, kind="stable")


def _index(keep_rows: bool) -> Callable:
    batch_column = "row" if keep_rows else "text"

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, block = zstandard.ZstdCompressor(1), TaskContext.get().partitionId() << 32
        for batch in sliced(batches, batch_column, BLOCK_BYTES):
            own = batch.column(1)
            texts = own.field(own.type.get_field_index("text")) if keep_rows else own
            n_words, terms, counts, positions = _posted(texts.to_pylist())
            steps = np.diff(positions, prepend=0)
            heads = np.cumsum(counts) - counts
            steps[heads[counts > 0]] = positions[heads[counts > 0]]  # every list starts anew
            ids = batch.column(0)
            known = pa.array([-1 if v is None else 1 for v in ids.to_pylist()], pa.int8()).to_numpy()
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes() + (known < 0).astype(np.uint8).tobytes()
            rows = None
            if keep_rows:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, pa.schema([("row", batch.schema.field("row").type)])) as out:
                    out.write_batch(pa.RecordBatch.from_arrays([own], names=["row"]))
                rows = packer.compress(sink.getvalue())
            cols = [n_words.astype("<u4").tobytes(), packer.compress(terms), counts.astype("<u4").tobytes(), packer.compress(steps.astype("<u4").tobytes()), rows]
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([ids], pa.binary()), *(pa.array([c], pa.binary()) for c in cols)], names=["block", "doc_ids", "n_words", "terms", "counts", "positions", "rows"])
            block += 1

    return index


def build_index(docs: DataFrame, keep_rows: bool = False) -> DataFrame:
    """The stored index of ``docs(doc_id, text)``: one row per block of documents, with the postings of all their terms.

    Null texts have no words, null ids stay null, repeated rows are documents of their own; an empty table
    gives an empty index.  ``keep_rows`` stores the documents' columns with the block, compressed.
    """
    text = F.col("text").cast("string").alias("text")
    given = F.struct(*(text if c == "text" else F.col(f"`{c}`") for c in docs.columns)).alias("row") if keep_rows else text
    at = docs.select(F.col("doc_id").cast("long"), given)
    return write_table(at.mapInArrow(_index(keep_rows), _INDEX_DDL), "postings")


class Postings:
    """A block's lists of the test terms."""

    def __init__(self, n_words: np.ndarray, terms: list[bytes], counts: np.ndarray, positions: np.ndarray, vocab: dict[bytes, int]) -> None:
        self.n_words = n_words
        self.starts = np.cumsum(n_words) - n_words
        self.span = int(n_words.sum()) + 1
        pairs = [(k, v) for k, v in enumerate(map(vocab.get, terms)) if v is not None]
        own = np.array(sorted(pairs, key=lambda p: p[1]), np.int64).reshape(-1, 2)
        self.counts = np.zeros(len(vocab), np.int64)
        self.counts[own[:, 1]] = counts[own[:, 0]]
        self.ends = np.concatenate(([0], np.cumsum(self.counts)))
        heads = np.cumsum(counts) - counts
        size = counts[own[:, 0]]
        stop = np.cumsum(size)
        take = np.repeat(heads[own[:, 0]] - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)
        self.positions = positions[take]
        self.keyed = np.repeat(np.arange(len(self.counts)), self.counts) * self.span + self.positions

    @classmethod
    def stored(cls, n_words: bytes, terms: bytes, counts: bytes, positions: bytes, vocab: dict[bytes, int]) -> Postings:
        unpack = zstandard.ZstdDecompressor()
        sizes = np.frombuffer(counts, "<u4").astype(np.int64)
        at = np.cumsum(np.frombuffer(unpack.decompress(positions), "<u4").astype(np.int64))
        if len(sizes):  # undo the steps list by list
            heads = np.cumsum(sizes) - sizes
            before = np.concatenate(([0], at))[heads]
            at = at - np.repeat(before, sizes)
        return cls(np.frombuffer(n_words, "<u4").astype(np.int64), unpack.decompress(terms).split(), sizes, at, vocab)

    def documents(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, pos, side="right") - 1

    def _groups(self, windows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(window, position of its rarest term, its terms' places from the rarest on) in bounded groups; windows without all terms are left out."""
        counts = np.where(windows >= 0, self.counts[windows], np.iinfo(np.int64).max)
        rows = np.flatnonzero(counts.min(axis=1, initial=np.iinfo(np.int64).max) > 0) if len(self.positions) else np.empty(0, np.int64)
        order = np.argsort(counts[rows], axis=1, kind="stable")
        n = counts[rows, order[:, 0]] if len(rows) else np.empty(0, np.int64)
        total = np.cumsum(n)
        at = 0
        while at < len(rows):
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + EXPANDED, side="right")))
            own, size = rows[at:stop], n[at:stop]
            ends = np.cumsum(size)
            take = np.repeat(self.ends[windows[own, order[at:stop, 0]]] - (ends - size), size) + np.arange(ends[-1])
            yield np.repeat(own, size), self.positions[take], np.repeat(order[at:stop], size, axis=0).astype(np.int8)
            at = stop

    def phrases(self, windows: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, start) of all exact occurrences, group by group."""
        for found, pos, order in self._groups(windows):
            pos = pos - order[:, 0]
            ok = pos >= 0
            for k in range(1, windows.shape[1]):
                found, pos, order = found[ok], pos[ok], order[ok]
                want = windows[found, order[:, k]]
                keys = want * self.span + pos + order[:, k]
                at = np.minimum(np.searchsorted(self.keyed, keys), len(self.keyed) - 1)
                ok = (want < 0) | (pos + order[:, k] < self.span) & (self.keyed[at] == keys)
            found, pos = found[ok], pos[ok]
            doc = self.documents(pos)
            ok = pos + sizes[found] <= self.starts[doc] + self.n_words[doc]
            yield found[ok], pos[ok]

    def near(self, windows: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, position of its rarest term) where every term occurs within ``reach`` words of it in the document."""
        for found, pos, order in self._groups(windows):
            doc = self.documents(pos)
            low = np.maximum(pos - reach, self.starts[doc])
            high = np.minimum(pos + reach, self.starts[doc] + self.n_words[doc] - 1)
            ok = np.ones(len(pos), bool)
            for k in range(1, windows.shape[1]):
                found, pos, order, low, high = found[ok], pos[ok], order[ok], low[ok], high[ok]
                want = windows[found, order[:, k]]
                a = np.searchsorted(self.keyed, want * self.span + low)
                b = np.searchsorted(self.keyed, want * self.span + high, side="right")
                ok = (want < 0) | (a < b)
            yield found[ok], pos[ok]


def _items_at(phrases: Phrases, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``window``, item) of every item of every window."""
    n = phrases.item_ends[window + 1] - phrases.item_ends[window]
    ends = np.cumsum(n)
    take = np.repeat(phrases.item_ends[window] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
    return np.repeat(np.arange(len(window)), n), phrases.items[take]


def _occurring(index: Postings, phrases: Phrases) -> tuple[np.ndarray, list[list[int]]]:
    """Hit words of the block, and per document the items with an occurring window."""
    delta = np.zeros(index.span, np.int64)
    items: list[list[int]] = [[] for _ in index.n_words]
    pairs = [np.empty((2, 0), np.int64)]
    for window, pos in index.phrases(phrases.windows, phrases.sizes):
        np.add.at(delta, pos, 1)
        np.subtract.at(delta, pos + phrases.sizes[window], 1)
        # Windows are asked once a document and group, however often they occur in it.
        asked = np.unique(index.documents(pos) * len(phrases.windows) + window)
        place, item = _items_at(phrases, asked % len(phrases.windows))
        pairs.append(np.unique(np.stack((asked[place] // len(phrases.windows), item)), axis=1))
    for d, i in zip(*np.unique(np.concatenate(pairs, axis=1), axis=1).tolist(), strict=True):
        items[d].append(i)
    return np.cumsum(delta[:-1]) > 0, items


# --- searches -------------------------------------------------------------------------------
_POSTINGS = ("block", "n_words", "terms", "counts", "positions")
_FOUND_DDL = "block long, doc int, hits binary, items array<long>"


def _positions_of(hit: np.ndarray, index: Postings) -> list[bytes]:
    """Hit word positions of each document, little-endian uint32."""
    return [np.flatnonzero(hit[s : s + w]).astype("<u4").tobytes() for s, w in zip(index.starts.tolist(), index.n_words.tolist(), strict=True)]


def _rows(batch: pa.RecordBatch, k: int, hits: list[bytes], items: list[list[int]], keep_rows: bool) -> pa.RecordBatch:
    """Result rows of a block's documents."""
    named = batch.schema.get_field_index
    raw = batch.column(named("doc_ids"))[k].as_py()
    n = len(raw) // 9
    ids = pa.array(np.frombuffer(raw, "<i8", n), mask=np.frombuffer(raw, np.uint8, n, 8 * n) > 0)
    words = np.frombuffer(batch.column(named("n_words"))[k].as_py(), "<u4").astype(np.int64)
    cols = [ids, pa.array(words), pa.array([len(h) // 4 for h in hits], pa.int64()), pa.array(hits, pa.binary()), pa.array(items, pa.list_(pa.int64()))]
    row = []
    if keep_rows:
        row = [pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(batch.column(named("rows"))[k].as_py())).read_next_batch().column(0)]
    return pa.RecordBatch.from_arrays([*cols, *row], names=["doc_id", "n_words", "n_hit", "hits", "items", *["row"] * len(row)])


def _block(batch: pa.RecordBatch, k: int, vocab: dict[bytes, int]) -> Postings:
    return Postings.stored(*(batch.column(batch.schema.get_field_index(c))[k].as_py() for c in _POSTINGS[1:]), vocab)


def _search(phrases: Phrases, keep_rows: bool) -> Callable:
    """One pass that settles the result: the test side is one chunk."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                index = _block(batch, k, phrases.vocab)
                hit, items = _occurring(index, phrases)
                yield _rows(batch, k, _positions_of(hit, index), items, keep_rows)

    return scan


def _search_part(phrases: Phrases) -> Callable:
    """Occurrences of one chunk's windows: a row per document that has any."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                index = _block(batch, k, phrases.vocab)
                hit, items = _occurring(index, phrases)
                some = [d for d, own in enumerate(items) if own]
                hits = _positions_of(hit, index) if some else []
                block = batch.column(0)[k].as_py()
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(some), pa.int64()), pa.array(some, pa.int32()), pa.array([hits[d] for d in some], pa.binary()), pa.array([items[d] for d in some], pa.list_(pa.int64()))], names=["block", "doc", "hits", "items"])

    return scan


def _united(keep_rows: bool) -> Callable:
    """Blocks with the occurrences of all passes (column ``found``) to result rows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                n = len(batch.column(batch.schema.get_field_index("n_words"))[k].as_py()) // 4
                hits: list[set[int]] = [set() for _ in range(n)]
                items: list[set[int]] = [set() for _ in range(n)]
                for f in batch.column(batch.schema.get_field_index("found"))[k].as_py() or ():
                    hits[f["doc"]].update(np.frombuffer(f["hits"], "<u4").tolist())
                    items[f["doc"]].update(f["items"])
                yield _rows(batch, k, [np.array(sorted(h), "<u4").tobytes() for h in hits], [sorted(i) for i in items], keep_rows)

    return scan


def _chunks(benchmark: DataFrame, chunk_bytes: int) -> Iterator[list[tuple[int, str]]]:
    items = text_columns(benchmark, "item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long"), "text")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    n = max(1, -(-2 * total // chunk_bytes))
    for k in range(n):  # hashed chunks hold half the bound on average; a single longer item still goes whole
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r[0], r[1]) for r in part.collect()]


def search(index: DataFrame, benchmark: DataFrame, window_words: int = WINDOW_WORDS, chunk_bytes: int = CHUNK_BYTES, row_type: str | None = None) -> DataFrame:
    """Exact matches of benchmark windows in a stored index: ``(doc_id, n_words, n_hit, hits, items[, row])``, a row per document row.

    ``hits`` are the positions of hit words (little-endian uint32), ``items`` the ids of items with an
    occurring window.  Benchmark rows with a null id or text have no windows; rows of one id are one item;
    an item of fewer words than a window is one window; an empty benchmark gives no hits.
    """
    keep = row_type is not None
    ddl = "doc_id long, n_words long, n_hit long, hits binary, items array<long>" + (f", row {row_type}" if keep else "")
    columns = [*_POSTINGS, "doc_ids", *["rows"] * keep]
    chunks = _chunks(benchmark, chunk_bytes)
    first, second = next(chunks), next(chunks, None)
    if second is None:
        return index.select(*columns).mapInArrow(_search(Phrases(first, window_words), keep), ddl)
    parts = [index.select(*_POSTINGS).mapInArrow(_search_part(Phrases(c, window_words)), _FOUND_DDL) for c in (first, second, *chunks)]
    found = reduce(DataFrame.unionAll, parts).groupBy("block").agg(F.collect_list(F.struct("doc", "hits", "items")).alias("found"))  # a block's documents are bounded
    return index.select("block", "doc_ids", "n_words", *["rows"] * keep).join(found, "block", "left").mapInArrow(_united(keep), ddl)


def contamination(docs: DataFrame, benchmark: DataFrame, window_words: int = WINDOW_WORDS, chunk_bytes: int = CHUNK_BYTES, keep_row: bool = False) -> DataFrame:
    """:func:`search` over the index of ``docs``, a row per document row.

    Null and empty texts have no words.  Repeated rows each get a row, empty documents an empty result.
    ``keep_row`` adds all columns of the document as the struct ``row``.
    """
    kind = None
    if keep_row:
        kind = "struct<" + ",".join(f"`{f.name}`:{'string' if f.name == 'text' else f.dataType.simpleString()}" for f in docs.schema) + ">"
    return search(build_index(docs, keep_row), benchmark, window_words, chunk_bytes, kind)


def short_items(benchmark: DataFrame, window_words: int = WINDOW_WORDS) -> list[int]:
    """Ids of items whose every text has fewer words than a window."""
    longest: dict[int, int] = {}
    for chunk in _chunks(benchmark, CHUNK_BYTES):
        for item, text in chunk:
            longest[item] = max(longest.get(item, 0), len(words_of(text)))
    return sorted(i for i, n in longest.items() if n < window_words)


def proximity_matches(index: DataFrame, benchmark: DataFrame, reach: int = 12, window_words: int = WINDOW_WORDS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(doc_id, item_id, position)`` from a stored index: places where all terms of an item's window lie within
    ``reach`` words of its rarest one (rarest in the block).  Rows are distinct within a document row."""

    def scan(phrases: Phrases) -> Callable:
        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    own = _block(batch, k, phrases.vocab)
                    raw = batch.column(batch.schema.get_field_index("doc_ids"))[k].as_py()
                    n = len(raw) // 9
                    ids, null = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, n, 8 * n) > 0
                    for window, pos in own.near(phrases.windows, reach):
                        place, item = _items_at(phrases, window)
                        rows = np.unique(np.stack((pos[place], item)), axis=1)
                        doc = own.documents(rows[0])
                        yield pa.RecordBatch.from_arrays([pa.array(ids[doc], mask=null[doc]), pa.array(rows[1]), pa.array(rows[0] - own.starts[doc]), pa.array(np.full(rows.shape[1], batch.column(0)[k].as_py())), pa.array(doc)], names=["doc_id", "item_id", "position", "block", "doc"])

        return near

    ddl = "doc_id long, item_id long, position long, block long, doc long"
    found = [index.select(*_POSTINGS, "doc_ids").mapInArrow(scan(Phrases(chunk, window_words)), ddl) for chunk in _chunks(benchmark, chunk_bytes)]
    return reduce(DataFrame.unionAll, found).distinct().drop("block", "doc")


def postings_table(index: DataFrame) -> DataFrame:
    """The stored index unfolded: ``(term, doc_id, positions)``, one row per term of a document row."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                terms = zstandard.ZstdDecompressor().decompress(batch.column(batch.schema.get_field_index("terms"))[k].as_py()).split()
                own = _block(batch, k, {t: i for i, t in enumerate(terms)})
                raw = batch.column(batch.schema.get_field_index("doc_ids"))[k].as_py()
                n = len(raw) // 9
                ids, null = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, n, 8 * n) > 0
                doc = own.documents(own.positions)
                term = np.repeat(np.arange(len(terms)), own.counts)
                heads = np.flatnonzero(np.diff(term * (n + 1) + doc, prepend=-1))
                for at in range(0, len(heads), 50_000):
                    part = heads[at : at + 50_000]
                    last = heads[at + 50_000] if at + 50_000 < len(heads) else len(term)
                    lists = pa.ListArray.from_arrays(pa.array(np.append(part, last) - part[0], pa.int32()), pa.array((own.positions - own.starts[doc])[part[0] : last]))
                    yield pa.RecordBatch.from_arrays([pa.array([terms[t].decode("utf-8", "replace") for t in term[part].tolist()], pa.string()), pa.array(ids[doc[part]], mask=null[doc[part]]), lists], names=["term", "doc_id", "positions"])

    return index.select(*_POSTINGS, "doc_ids").mapInArrow(unfold, "term string, doc_id long, positions array<long>")


def digest(found: DataFrame, min_items: int = MIN_ITEMS) -> DataFrame:
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("items") >= min_items).alias("contaminated"),
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))


OP10_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, len(w[i:i+7]) AS n, array_to_string(w[i:i+7], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 7, 1) + 1)) AS i FROM bw WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM win
), pos AS (
  SELECT doc_id, i, n, array_to_string(w[i:i+n-1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)
), occ AS (SELECT p.doc_id, p.i, p.n, win.item_id FROM pos p JOIN win USING (n, k)
), hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM occ) GROUP BY doc_id
), it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM occ) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM dw d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
