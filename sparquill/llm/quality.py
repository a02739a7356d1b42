"""Quality by ordinal cumulative-link regression on hashed text.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight vector for all grades, ordered thresholds.
x holds relative frequencies of hashed words and of hashed word shapes, and a few measures of
repetition.  The fit sees a bounded sample of rated documents (:data:`MAX_RATED`, by hash of the
id); scoring covers every document and the whole text, with no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.llm._runtime import labelled_texts, read, sliced, text_columns

#: Rated documents that the fit sees at most.
MAX_RATED = 5_000
#: Bytes of their texts at most.
MAX_BYTES = 64 << 20
WORD_BITS, SHAPE_BITS = 15, 12
N_DENSE = 5
_SHAPE = bytes(ord("a") if 97 <= c <= 122 or c >= 128 else ord("A") if 65 <= c <= 90 else ord("9") if 48 <= c <= 57 else c for c in range(256))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def featurize(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashed indices, row ends, value of each row's entries, dense measures) of whole texts."""
    cols, ends, scale, dense = [], [0], np.zeros(len(texts)), np.zeros((len(texts), N_DENSE))
    for k, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.translate(_LOWER).split()
        n = len(words)
        if n:
            h = np.fromiter(map(crc32, words), np.int64, n)
            s = np.fromiter(map(crc32, raw.translate(_SHAPE).split()), np.int64, n)
            cols += [h & ((1 << WORD_BITS) - 1), (1 << WORD_BITS) + (s & ((1 << SHAPE_BITS) - 1))]
            scale[k] = 1 / n
            same = float(np.count_nonzero(h[1:] == h[:-1])) / n
            sheer = len(raw) / n
            dense[k] = (1.0, same, len(np.unique(h)) / n, min(np.log1p(n) / 8, 1.5), min(sheer / 10, 5.0))
        else:
            dense[k, 0] = 1.0
        ends.append(ends[-1] + 2 * n)
    return (np.concatenate(cols) if cols else np.empty(0, np.int64)), np.array(ends), scale, dense


class Ordinal:
    """Cumulative-link model; ``grades`` ascend, one threshold between each two neighbours."""

    def __init__(self, grades: list[int]) -> None:
        self.grades = np.array(sorted(grades), np.float64)
        self.w = np.zeros((1 << WORD_BITS) + (1 << SHAPE_BITS))
        self.d = np.zeros(N_DENSE)
        self.first, self.gaps = -1.0, np.zeros(max(0, len(grades) - 2))  # gaps in log

    @property
    def thresholds(self) -> np.ndarray:
        return self.first + np.concatenate(([0.0], np.cumsum(np.exp(self.gaps))))

    def raw(self, cols: np.ndarray, ends: np.ndarray, scale: np.ndarray, dense: np.ndarray) -> np.ndarray:
        sums, some = np.zeros(len(scale)), np.flatnonzero(ends[1:] > ends[:-1])
        if len(some):  # row by row, so that a score does not depend on the rows beside it
            sums[some] = np.add.reduceat(self.w[cols], ends[some])
        return sums * scale + (dense * self.d).sum(axis=1)

    def tails(self, raw: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold, columns descending."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - raw[:, None], -60, 60)))

    def fit(self, texts: list[str], y: list[int], rounds: int = 80, rate: float = 0.2, decay: float = 1e-5) -> Ordinal:
        """Maximum likelihood with ridge decay, Adam over all rated rows at once."""
        if len(self.grades) < 2 or not texts:
            return self
        cols, ends, scale, dense = featurize(texts)
        level = np.searchsorted(self.grades, np.array(y))
        n, m = len(texts), len(self.grades) - 1
        row = np.repeat(np.arange(n), np.diff(ends))
        params = [self.w, self.d, np.array([self.first]), self.gaps]
        moment, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, rounds + 1):
            self.first = float(params[2][0])
            raw, th = self.raw(cols, ends, scale, dense), self.thresholds
            cdf = np.hstack((np.zeros((n, 1)), 1 / (1 + np.exp(np.clip(raw[:, None] - th, -60, 60))), np.ones((n, 1))))
            at = np.arange(n)
            p = np.maximum(cdf[at, level + 1] - cdf[at, level], 1e-12)
            up, low = cdf[at, level + 1] * (1 - cdf[at, level + 1]), cdf[at, level] * (1 - cdf[at, level])
            g_raw = (up - low) / p / n  # of the negative log likelihood
            g_th = np.zeros(m)
            np.add.at(g_th, np.minimum(level, m - 1), np.where(level < m, -up / p / n, 0))
            np.add.at(g_th, np.maximum(level - 1, 0), np.where(level > 0, low / p / n, 0))
            g_gap = np.cumsum(g_th[::-1])[::-1][1:] * np.exp(self.gaps)
            grads = [np.bincount(cols, (g_raw * scale)[row], len(self.w)) + decay * self.w, g_raw @ dense + decay * self.d, np.array([g_th.sum()]), g_gap]
            for q, g, a, b in zip(params, grads, moment, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                q -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-10)
            self.first = float(params[2][0])
        return self


def rated_sample(docs: DataFrame, ratings: DataFrame, grade: str = "quality", most: int = MAX_RATED) -> tuple[list[str], list[int]]:
    """Texts and grades of at most ``most`` rated documents, chosen by hash of the id; rows without text or grade don't count.

    The chosen ratings (a bounded table) go to the documents, so no text is shuffled.
    """
    chosen = (
        text_columns(ratings, "doc_id", grade)
        .where(f"doc_id IS NOT NULL AND `{grade}` IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min(grade).cast("int").alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    rows = labelled_texts(docs, chosen, "grade", MAX_BYTES)
    return [r[2] for r in rows], [r[1] for r in rows]


def train(docs: DataFrame, ratings: DataFrame, grade: str = "quality", most: int = MAX_RATED) -> Ordinal:
    texts, grades = rated_sample(docs, ratings, grade, most)
    return Ordinal(sorted(set(grades)) or [0, 1]).fit(texts, grades)


def _scores(model: Ordinal, cut: float) -> Callable:
    def score(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        raw = model.raw(*featurize(texts))
        tails = model.tails(raw) if len(model.grades) > 1 else np.ones((len(texts), 1))
        expected = model.grades[0] + tails @ np.diff(model.grades) if len(model.grades) > 1 else np.full(len(texts), model.grades[0])
        above = np.searchsorted(model.grades[1:], cut) if len(model.grades) > 1 else 0
        tail = tails[:, above] if above < tails.shape[1] else np.zeros(len(texts))
        return expected, tail

    return score


def graded(docs: DataFrame, model: Ordinal, cut: float = 1, keep_at: float = 0.5) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, expected_grade, p_tail, kept)``, one row per input row.

    ``p_tail`` is the probability of grade ``cut`` or above, ``kept`` whether it reaches ``keep_at``.
    Null and empty texts have no words and are scored from the intercept alone, but never kept.
    Without ratings every weight is zero and nothing with words is rejected.
    """
    score, informed = _scores(model, cut), bool(np.any(model.w))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 4 << 20):
            texts = batch.column(1).to_pylist()
            expected, tail = score(texts)
            kept = np.array([bool(t and t.strip()) for t in texts]) & ((tail >= keep_at) | (not informed))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(expected), pa.array(tail), pa.array(kept)], names=["doc_id", "expected_grade", "p_tail", "kept"])

    rows = text_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(scan, "doc_id long, expected_grade double, p_tail double, kept boolean")


def selected(docs: DataFrame, model: Ordinal, cut: float = 1, keep_at: float = 0.5) -> DataFrame:
    """The documents :func:`graded` keeps, all columns as they are."""
    score, informed, at = _scores(model, cut), bool(np.any(model.w)), docs.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 4 << 20):
            texts = batch.column(at).to_pylist()
            _, tail = score(texts)
            kept = np.array([bool(t and t.strip()) for t in texts]) & ((tail >= keep_at) | (not informed))
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(scan, docs.schema)


def op5_quality_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return graded(docs, train(docs, read(spark, sf_dir, "labels")))
