"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Terms are all words of a text and the prefixes of longer words, hashed to :data:`TERMS` numbers (words
that share a number are one term).  A term weighs its logarithmic count times its inverse document
frequency, counted over the whole corpus, times a relevance that the labelled examples give it: terms
that their labels depend on (chi-square) weigh more, no term weighs nothing.  So every text with a word
has a vector over all of its terms, and is compared with the examples.

The examples (a bounded sample, :data:`MAX_EXAMPLES`) stand in blocks, alike ones together.  The index
keeps posting lists per term; lists that a good part of the examples is on are stored dense, with the
largest weight in each block.  A batch of documents gets a bound for every block, takes the blocks of
highest bound first, and leaves out blocks whose bound is below the k-th best cosine.  This search is in
single precision, with room for all of its error; what it finds is summed again in double precision, so
the k nearest are exact.  Their votes, weighted by squared cosine, go through a logistic calibration that was fitted on
examples scored by an index of the other examples; the neighbours are the evidence.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.llm._runtime import cuts, labelled_texts, read, sliced, text_columns

#: Labelled rows that are examples at most: half of them of each label, by hash of the id.
MAX_EXAMPLES = 4_000
#: Bytes of their texts at most.
MAX_BYTES = 64 << 20
#: Numbers that terms are hashed to.
TERMS = 1 << 18
NEIGHBOURS = 15
FOLDS = 5
BLOCK = 64
PREFIXES = (4, 5, 6, 7, 8)
#: Terms with dense lists.
DENSE = 2048
#: Share of a cosine that single precision may cost: weights are at least zero, so each sum of up to DENSE + 1 products is off by that many roundings at most.
ERROR = (DENSE + 16) * 2.0**-23
#: Documents scored together, those whose posting lists are held at once, and characters and words that are.
BATCH, GROUP, PIECE, WORDS = 64, 4, 1 << 20, 1 << 18
#: Examples that are scored for the calibration at most, and the parts they are dealt into.
CALIBRATED, PARTS = 1_500, 3
#: Chi-square that chance explains, and the relevance of terms below it.
CHANCE, PLAIN = 6.0, 0.5
#: Whatever is no letter of a lowered text becomes a separator.
_WORDS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Registers of CRC-32 by byte; words of more than LONG bytes are hashed one at a time.
_CRC = np.array([crc32(bytes([c])) ^ crc32(b"\0") for c in range(256)], np.uint32)
LONG = 24


def held_out(doc_id) -> bool:
    return crc32(str(doc_id).encode()) % FOLDS == 0


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_WORDS).split()


def terms_of(word: bytes) -> list[int]:
    """Numbers of a word and of its prefixes (marked with a star)."""
    return [crc32(t) % TERMS for t in (word, *(word[:k] + b"*" for k in PREFIXES if len(word) > k))]


def _summed(text: np.ndarray, term: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of equal (text, term) added up, in order of both."""
    key = text.astype(np.int64) * TERMS + term
    order = np.argsort(key, kind="stable")
    key = key[order]
    heads = np.flatnonzero(np.diff(key, prepend=-1))
    total = np.add.reduceat(count[order], heads) if len(heads) else np.empty(0, np.int64)
    return (key[heads] // TERMS).astype(np.int32), (key[heads] % TERMS).astype(np.int32), total.astype(np.int32)


def _step(register: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    """Registers of CRC-32 after one more byte."""
    return _CRC[(register ^ byte) & 255] ^ (register >> 8)


def _number(register: np.ndarray) -> np.ndarray:
    return ((register ^ 0xFFFFFFFF) % TERMS).astype(np.int32)


class Bags:
    """Term counts of whole texts, as :func:`terms_of` has them: the bytes of all words are hashed side by side."""

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, count) of every term of every text, in order of text and term; long texts go piece by piece."""
        found, at = [], 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and stop - at < 4 * BATCH and (size := size + len(texts[stop] or "")) <= PIECE:
                stop += 1
            if stop > at:
                own = self._count([t or "" for t in texts[at:stop]])
            else:
                stop, pieces = at + 1, [self._count([p]) for p in cuts(texts[at], PIECE)]
                own = pieces[0] if len(pieces) == 1 else _summed(*(np.concatenate(x) for x in zip(*pieces, strict=True)))
            found.append((own[0] + np.int32(at), *own[1:]))
            at = stop
        if len(found) == 1:
            return found[0]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else tuple(np.empty(0, np.int32) for _ in range(3))

    def _count(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
        whole = b" ".join([b"", *own, b""]).translate(_WORDS)  # a blank before and after each text
        data = np.frombuffer(whole, np.uint8)
        edges = np.flatnonzero(np.diff(data != 32))
        start, stop = edges[::2] + 1, edges[1::2] + 1
        begin = np.cumsum([1 + len(o) for o in own]) - [len(o) for o in own]
        text = np.repeat(np.arange(len(own), dtype=np.int32), np.diff(np.searchsorted(start, begin), append=len(start)))
        parts = [self._hashed(whole, data, text[k : k + WORDS], start[k : k + WORDS], stop[k : k + WORDS]) for k in range(0, max(1, len(start)), WORDS)]
        return parts[0] if len(parts) == 1 else _summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))

    @staticmethod
    def _hashed(whole: bytes, data: np.ndarray, text: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, count) of the words that stand in ``whole`` from ``start`` to ``stop``."""
        length = np.minimum(stop - start, LONG + 1).astype(np.uint8)
        order = np.argsort(length, kind="stable")[::-1]  # long words first: those with another byte stand in front
        text, start, stop = text[order], start[order], stop[order]
        longer = len(length) - np.cumsum(np.bincount(length, minlength=LONG + 2))  # words of more than so many bytes
        register = np.full(len(start), 0xFFFFFFFF, np.uint32)
        keys = []
        for k in range(LONG):
            n = longer[k]
            if not n:
                break
            if k in PREFIXES:
                keys.append(text[:n] * np.int32(TERMS) + _number(_step(register[:n], ord("*"))))
            register[:n] = _step(register[:n], data[start[:n] + k])
        term = _number(register)
        n = int(longer[LONG])
        term[:n] = [crc32(whole[a:b]) % TERMS for a, b in zip(start[:n].tolist(), stop[:n].tolist(), strict=True)]
        key = np.sort(np.concatenate((*keys, text * np.int32(TERMS) + term)))
        heads = np.flatnonzero(np.diff(key, prepend=-1))
        return key[heads] // TERMS, key[heads] % TERMS, np.diff(heads, append=len(key)).astype(np.int32)


def relevance(text: np.ndarray, term: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Weight of each term by how far labels depend on it: the root of chi-square beyond chance, and :data:`PLAIN`."""
    n1, n0 = float(toxic.sum()), float(len(toxic) - toxic.sum())
    if not n1 or not n0:
        return np.full(TERMS, PLAIN)
    a = np.bincount(term, toxic[text].astype(np.float64), TERMS)
    b = np.bincount(term, minlength=TERMS) - a
    c, d = n1 - a, n0 - b
    chi = (a * d - b * c) ** 2 * (n1 + n0) / np.maximum((a + b) * (c + d) * n1 * n0, 1.0)
    return PLAIN + np.sqrt(np.maximum(chi - CHANCE, 0.0))


def unit(bag: tuple[np.ndarray, np.ndarray, np.ndarray], n: int, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as (text, term, weight) from counts."""
    text, term, count = bag
    w = (1 + np.log(count)) * weight[term]
    norm = np.sqrt(np.bincount(text, w * w, n))
    return text, term, w / np.where(norm > 0, norm, 1.0)[text]


class BlockMaxIndex:
    """Unit vectors of the examples: posting lists, dense ones with their maxima per block of examples."""

    def __init__(self, bag: tuple[np.ndarray, np.ndarray, np.ndarray], labels: np.ndarray, ids: np.ndarray, weight: np.ndarray) -> None:
        n = len(ids)
        text, term, w = unit(bag, n, weight)
        # Examples whose heaviest terms are the same stand together, which makes block maxima tight.
        lead = np.full(n, -1, np.int64)
        heavy = np.lexsort((term, w, text))
        last = np.flatnonzero(np.diff(text[heavy], append=n))
        lead[text[heavy[last]]] = term[heavy[last]]
        common = np.full(n, -1, np.int64)
        many = np.bincount(term, minlength=TERMS)
        often = np.lexsort((term, many[term], text))
        common[text[often[last]]] = term[often[last]]
        del heavy, often
        order = np.lexsort((ids, lead, common))
        place = self.place = np.empty(n, np.int32)
        place[order] = np.arange(n)
        self.weight, self.ids, self.labels, self.n = weight, ids[order], labels[order].astype(np.float64), n
        # The vectors themselves: terms and codes of their logarithmic counts; equal ones are found under the first.
        counts = np.unique(bag[2])
        self.terms, self.logs = term, 1 + np.log(counts)
        self.codes = np.searchsorted(counts, bag[2]).astype(np.min_scalar_type(len(counts)))
        self.spans = np.searchsorted(text, np.arange(n + 1))
        self.norm = np.sqrt([np.sum((self.logs[self.codes[a:b]] * weight[term[a:b]]) ** 2) for a, b in zip(self.spans[:-1], self.spans[1:], strict=True)])
        same: dict[bytes, int] = {}
        spans = zip(self.spans[:-1].tolist(), self.spans[1:].tolist(), strict=True)
        self.first = np.array([same.setdefault(blake2b(term[a:b].tobytes() + bag[2][a:b].tobytes()).digest(), i) for i, (a, b) in enumerate(spans)], np.int64)[order]
        self.n_blocks = -(-n // BLOCK)
        self.dense_terms = np.argsort(-many, kind="stable")[: min(DENSE, int((many > 0).sum()))]
        self.slot = np.full(TERMS, -1, np.int32)
        self.slot[self.dense_terms] = np.arange(len(self.dense_terms))
        at, thick = place[text], self.slot[term] >= 0
        lists = np.lexsort((at[~thick], term[~thick]))
        self.lists = np.empty(len(lists), [("row", np.int32), ("value", np.float32)])
        self.lists["row"], self.lists["value"] = at[~thick][lists], w[~thick][lists]
        self.ends = np.concatenate(([0], np.cumsum(np.bincount(term[~thick], minlength=TERMS)))).astype(np.int32)
        self._fill()

    def _fill(self) -> None:
        """The dense lists and their maxima, from the vectors."""
        thick = np.flatnonzero(self.slot[self.terms] >= 0)
        own, term = np.repeat(np.arange(self.n), np.diff(self.spans))[thick], self.terms[thick]
        self.dense = np.zeros((len(self.dense_terms), self.n_blocks * BLOCK), np.float32)
        self.dense[self.slot[term], self.place[own]] = self.logs[self.codes[thick]] * self.weight[term] / np.where(self.norm > 0, self.norm, 1.0)[own]
        self.maxima = self.dense.reshape(len(self.dense_terms), self.n_blocks, BLOCK).max(axis=2, initial=0.0)

    def __getstate__(self) -> dict:
        return {k: v for k, v in vars(self).items() if k not in ("dense", "maxima")}  # most of the bytes, mostly zeros

    def __setstate__(self, state: dict) -> None:
        vars(self).update(state)
        self._fill()

    def nearest(self, bag: tuple[np.ndarray, np.ndarray, np.ndarray], n: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Positions and cosines of the k nearest examples of each of ``n`` texts, ties by position (-1: none with a common term left), and how many blocks were scored."""
        k = min(k, self.n)
        if not self.n or not n:
            return np.full((n, k), -1), np.zeros((n, k)), 0
        text, term, w = unit(bag, n, self.weight)
        heads, width = np.searchsorted(text, np.arange(n + 1)), self.n_blocks * BLOCK
        slot = self.slot[term]
        thick = slot >= 0
        q = np.zeros((n, len(self.dense_terms)), np.float32)
        q[text[thick], slot[thick]] = w[thick]
        score = np.empty((n, self.n_blocks, BLOCK), np.float32)
        for at in range(0, n, GROUP):
            stop = min(at + GROUP, n)
            score[at:stop] = self._listed(*(x[heads[at] : heads[stop]] for x in (text, term, w)), at, stop).reshape(stop - at, self.n_blocks, BLOCK)
        bound = score.max(axis=2) + q @ self.maxima
        scored = np.zeros((n, self.n_blocks), bool)
        first_blocks = -(-k // BLOCK)
        top = np.argpartition(-bound, first_blocks - 1, axis=1)[:, :first_blocks] if first_blocks < self.n_blocks else np.tile(np.arange(self.n_blocks), (n, 1))
        wanted = np.zeros((n, self.n_blocks), bool)
        np.put_along_axis(wanted, top, True, axis=1)
        for _ in range(2):  # blocks of the highest bounds give a floor; then all blocks that could pass it
            if 2 * wanted.sum() > wanted.size:  # one product costs less than that of many blocks
                np.add(score, (q @ self.dense).reshape(score.shape), out=score, where=wanted[:, :, None])
            else:
                for b in np.flatnonzero(wanted.any(axis=0)).tolist():
                    rows = np.flatnonzero(wanted[:, b])
                    score[rows, b] += q[rows] @ self.dense[:, b * BLOCK : (b + 1) * BLOCK]
            scored |= wanted
            have = np.where(scored[:, :, None], score, np.float32(0)).reshape(n, width)
            floor = -np.partition(-have, k - 1, axis=1)[:, k - 1] * (1 - 2 * ERROR)
            wanted = ~scored & (bound >= floor[:, None]) & (bound > 0)
        row, at = np.nonzero((have >= floor[:, None]) & (have > 0))
        exact = self._exact(term, w, heads, row, at)
        order = np.lexsort((at, -exact, row))
        row, at, exact = row[order], at[order], exact[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        row, at, exact, rank = row[rank < k], at[rank < k], exact[rank < k], rank[rank < k]
        position, cosine = np.full((n, k), -1), np.zeros((n, k))
        position[row, rank], cosine[row, rank] = at, exact
        return position, cosine, int(scored.sum())

    def _listed(self, text: np.ndarray, term: np.ndarray, w: np.ndarray, at: int, stop: int) -> np.ndarray:
        """What the posting lists add to the cosines of the texts from ``at`` to ``stop`` with every example."""
        first, size = self.ends[term], self.ends[term + 1] - self.ends[term]
        some = np.flatnonzero(size)  # dense terms have no list
        text, w, first, size = text[some], w[some], first[some], size[some]
        take = np.repeat(first - (np.cumsum(size, dtype=np.int64) - size), size)
        take += np.arange(len(take))
        listed = self.lists.view(np.int64).take(take, mode="clip").view(self.lists.dtype)  # a row and its value at once
        cell, value = np.repeat((text - at).astype(np.int64) * (self.n_blocks * BLOCK), size), np.repeat(w, size)
        cell += listed["row"]
        value *= listed["value"]
        return np.bincount(cell, value, (stop - at) * self.n_blocks * BLOCK)

    def _exact(self, term: np.ndarray, w: np.ndarray, heads: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Cosines in double precision of texts ``row`` (in order) with the examples at ``at``; equal examples are summed once."""
        pair, back = np.unique(row * self.n + self.first[at], return_inverse=True)
        own, which = np.divmod(pair, self.n)
        ends, found = np.searchsorted(own, np.arange(len(heads))), np.zeros(len(pair))
        weight = np.zeros(TERMS)
        for k in np.flatnonzero(np.diff(ends)).tolist():
            mine = term[heads[k] : heads[k + 1]]
            weight[mine] = w[heads[k] : heads[k + 1]] * self.weight[mine]
            spans = [(self.spans[i], self.spans[i + 1]) for i in which[ends[k] : ends[k + 1]].tolist()]
            parts = weight.take(np.concatenate([self.terms[a:b] for a, b in spans]), mode="clip")
            parts *= self.logs.take(np.concatenate([self.codes[a:b] for a, b in spans]), mode="clip")
            found[ends[k] : ends[k + 1]] = np.add.reduceat(parts, np.cumsum([0, *(b - a for a, b in spans[:-1])]))
            weight[mine] = 0.0
        return (found / self.norm[which])[back]

    def neighbours(self, bag: tuple[np.ndarray, np.ndarray, np.ndarray], own: list[int | None], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(positions, cosines, counted): the k nearest of each text; a document is no neighbour of itself."""
        position, cosine, _ = self.nearest(bag, len(own), k + 1)
        ids = np.array([np.iinfo(np.int64).min if i is None else i for i in own], np.int64)
        counted = position >= 0
        if counted.size:
            counted &= self.ids[position] != ids[:, None]
        counted &= np.cumsum(counted, axis=1) <= k
        return position, cosine, counted

    def votes(self, found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """Per text: votes for toxic, votes against, their share of toxic ones, each weighted by squared cosine."""
        position, cosine, counted = found
        if not self.n:
            return np.zeros((len(position), 3))
        weight = cosine * cosine * counted
        toxic = (weight * self.labels[position]).sum(axis=1)
        total = weight.sum(axis=1)
        return np.stack((toxic, total - toxic, toxic / np.where(total > 0, total, 1.0)), axis=1)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Coefficients of (1, x) by Newton steps on the weighted likelihood."""
    x = np.hstack((np.ones((len(x), 1)), x))
    b, pull = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + pull, x.T @ (weight * (y - p)) - ridge * b)
        b = b + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return b


class Scorer:
    """The index, the calibration and the base rate, as the tasks get them."""

    def __init__(self, rows: list[tuple[int, int, str]], idf: np.ndarray, counts: tuple[int, int] | None = None, k: int = NEIGHBOURS) -> None:
        """``rows`` are (doc_id, toxic, text); ``counts`` the numbers of labelled rows (not toxic, toxic) that they stand for."""
        self.k = k
        ids = np.array([r[0] for r in rows], np.int64)
        labels = np.array([r[1] == 1 for r in rows], bool)
        bag = Bags()([r[2] for r in rows])
        n0, n1 = counts or (int((~labels).sum()), int(labels.sum()))
        self.base = (n1 + 0.5) / (n0 + n1 + 2)
        share = np.where(labels, n1 / max(1, labels.sum()), n0 / max(1, (~labels).sum())) if len(rows) else np.empty(0)
        part = np.array([crc32(b"part%d" % i) % PARTS for i in ids.tolist()], np.int64)
        some = np.zeros(len(rows), bool)
        for label in (False, True):
            some[np.flatnonzero(labels == label)[: CALIBRATED // 2]] = True
        x, y, w = [], [], []
        for p in range(PARTS) if 0 < labels.sum() < len(labels) else ():
            asked, rest = part == p, part != p
            index = self._index(bag, rest, labels, ids, idf)
            for at in np.array_split(np.flatnonzero(asked & some), -(-int((asked & some).sum()) // BATCH) or 1):
                x.append(index.votes(index.neighbours(self._rows(bag, at), ids[at].tolist(), k)))
                y.append(labels[at])
                w.append(share[at])
        self.calibration = logistic(np.concatenate(x), np.concatenate(y).astype(np.float64), np.concatenate(w)) if x else None
        self.index = self._index(bag, np.ones(len(rows), bool), labels, ids, idf)

    @staticmethod
    def _rows(bag: tuple[np.ndarray, np.ndarray, np.ndarray], at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bags of the texts ``at``, numbered from 0."""
        if not len(at):
            return tuple(b[:0] for b in bag)
        new = np.full(max(int(at.max()), int(bag[0].max(initial=0))) + 1, -1, np.int32)
        new[at] = np.arange(len(at))
        own = new[bag[0]] >= 0
        return new[bag[0][own]], bag[1][own], bag[2][own]

    def _index(self, bag: tuple, rows: np.ndarray, labels: np.ndarray, ids: np.ndarray, idf: np.ndarray) -> BlockMaxIndex:
        own = self._rows(bag, np.flatnonzero(rows))
        return BlockMaxIndex(own, labels[rows], ids[rows], idf * relevance(own[0], own[1], labels[rows]))

    def score(self, bag: tuple[np.ndarray, np.ndarray, np.ndarray], own: list[int | None]) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Scores, and the neighbours behind them; without a neighbour the score is the base rate."""
        found = self.index.neighbours(bag, own, self.k)
        votes = self.index.votes(found)
        score = np.full(len(own), self.base)
        if self.calibration is not None:
            z = self.calibration[0] + votes @ self.calibration[1:]
            score = np.where(found[2].any(axis=1), 1 / (1 + np.exp(-np.clip(z, -30, 30))), score)
        return score, found


def labelled(labels: DataFrame) -> DataFrame:
    """``(doc_id, toxic)`` of labelled rows outside the held-out fold, one row per id (toxic if any of its rows is)."""
    return (
        text_columns(labels, "doc_id", "toxic")
        .where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each term, and all documents, counted over the whole table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags, df, n = Bags(), np.zeros(TERMS, np.int64), 0
        for batch in sliced(batches, "text", 1 << 20):
            df += np.bincount(bags(batch.column(0).to_pylist())[1], minlength=TERMS)
            n += batch.num_rows
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-1], seen))), pa.array(np.concatenate(([n], df[seen])))], names=["term", "n"])

    counted = text_columns(docs, "text").select(F.col("text").cast("string")).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = (counted.column(c).to_numpy() for c in ("term", "n"))
    df = np.zeros(TERMS, np.int64)
    df[term[term >= 0]] = n[term >= 0]
    return df, int(n[term < 0].sum())


def train(docs: DataFrame, labels: DataFrame, most: int = MAX_EXAMPLES, k: int = NEIGHBOURS) -> Scorer:
    """The scorer from at most ``most`` labelled rows; document frequencies come from all documents."""
    known = labelled(labels)
    sides = [known.where(F.col("toxic") == t if t else F.col("toxic") != 1) for t in (0, 1)]
    chosen = [s.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most // 2) for s in sides]
    rows = labelled_texts(docs, chosen[0].unionAll(chosen[1]), "toxic", MAX_BYTES)
    total = {bool(r["t"]): r["n"] for r in known.groupBy((F.col("toxic") == 1).alias("t")).agg(F.count("*").alias("n")).collect()}
    df, n = document_frequencies(docs)
    return Scorer(rows, np.log((1 + n) / (1 + df)), (total.get(False, 0), total.get(True, 0)), k)


def scored(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, held_out, score, predicted, evidence)``, one row per input row.

    ``evidence`` lists the nearest examples with their cosines.  Null and empty texts, and texts that share
    no term with an example, get the base rate and no evidence.  Without labelled rows of both kinds every
    score is that base.  Repeated rows each get a row; a null doc_id counts as not held out; extra columns
    are ignored; an empty table gives an empty result.
    """
    struct = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64())]))
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # bounded by MAX_EXAMPLES and MAX_BYTES

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, bags = shared.value, Bags()
        for part in sliced(batches, "text", 1 << 20):
            for at in range(0, part.num_rows, BATCH):
                batch = part.slice(at, BATCH)
                ids = batch.column(0).to_pylist()
                scores, (position, cosine, counted) = own.score(bags(batch.column(1).to_pylist()), ids)
                near = own.index.ids[position] if own.index.n else position
                ends = np.concatenate(([0], np.cumsum(counted.sum(axis=1)))).astype(np.int32)
                evidence = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(near[counted]), pa.array(cosine[counted])], names=["doc_id", "cosine"]))
                cols = [batch.column(0), pa.array([d is not None and held_out(d) for d in ids]), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), evidence.cast(struct)]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "held_out", "score", "predicted", "evidence"])

    rows = text_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(scan, "doc_id long, held_out boolean, score double, predicted int, evidence array<struct<doc_id:long,cosine:double>>")


def op2_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return scored(docs, train(docs, read(spark, sf_dir, "labels")))
