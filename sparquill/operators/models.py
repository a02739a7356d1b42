"""Interfaces of external models, with deterministic stand-ins.

The stand-ins make every stage runnable and testable; they claim no agreement with any real model.
A real model is another ``load`` function: it runs once per task and its result sees Arrow batches.
Models run in ``mapInArrow``, a barrier to the optimiser: calls are neither repeated nor moved.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _appended(rows: DataFrame, inputs: list[str], to: str, kind: T.DataType, arrow: pa.DataType, load: Callable, batch: int, call: Callable) -> DataFrame:
    """``rows`` with a column of ``call(model, *texts)``, texts of the input columns with null as empty."""
    rows = rows.drop(to)
    places = [rows.columns.index(c) for c in inputs]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for part in batches:
            for at in range(0, part.num_rows, batch):
                own = part.slice(at, batch)
                texts = [[t or "" for t in own.column(p).to_pylist()] for p in places]
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(call(model, *texts), arrow)], names=[*own.schema.names, to])

    return rows.mapInArrow(scan, T.StructType([*rows.schema.fields, T.StructField(to, kind)]))


class Encoder:
    """Text to unit vectors.  ``load`` returns a function from a list of texts to a matrix."""

    def __init__(self, load: Callable[[], Callable[[list[str]], np.ndarray]], batch: int = 64) -> None:
        self.load, self.batch = load, batch

    def with_vector(self, rows: DataFrame, text: str, to: str = "embedding") -> DataFrame:
        def call(model: Callable, texts: list[str]) -> list:
            x = np.asarray(model(texts), np.float32)
            norm = np.linalg.norm(x, axis=1, keepdims=True)
            norm[norm == 0] = 1
            return list(x / norm)

        return _appended(rows, [text], to, T.ArrayType(T.FloatType()), pa.list_(pa.float32()), self.load, self.batch, call)


def hashing_encoder(dim: int = 64) -> Encoder:
    """Signed hashed bag of words."""

    def load() -> Callable[[list[str]], np.ndarray]:
        def encode(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), dim), np.float32)
            for k, text in enumerate(texts):
                for w in text.lower().split():
                    h = crc32(w.encode())
                    out[k, h % dim] += 1 if h >> 16 & 1 else -1
            return out

        return encode

    return Encoder(load)


class YesNoScorer:
    """Probability of yes for a text; ``load`` returns a function from texts to (yes, no) logits."""

    def __init__(self, load: Callable[[], Callable[[list[str]], tuple[np.ndarray, np.ndarray]]]) -> None:
        self.load = load

    def with_score(self, rows: DataFrame, text: str, to: str, batch: int = 64) -> DataFrame:
        def call(model: Callable, texts: list[str]) -> np.ndarray:
            yes, no = model(texts)
            return 1 / (1 + np.exp(np.asarray(no, float) - np.asarray(yes, float)))

        return _appended(rows, [text], to, T.DoubleType(), pa.float64(), self.load, batch, call)


def keyword_scorer(*words: str) -> YesNoScorer:
    """Logit of yes: how often the words occur; of no: 1."""

    def load():
        return lambda texts: (np.array([sum(t.lower().count(w) for w in words) for t in texts], float), np.ones(len(texts)))

    return YesNoScorer(load)


def overlap_score(query, document):
    """Column stand-in of a reranker: share of the query's distinct words that the document has."""
    q, d = F.array_distinct(F.split(F.lower(query), " ")), F.array_distinct(F.split(F.lower(document), " "))
    return F.size(F.array_intersect(q, d)) / F.size(q)


class Reranker:
    """Score of (query, document), higher for better; ``load`` returns a function from lists of both to scores."""

    def __init__(self, load: Callable[[], Callable[[list[str], list[str]], np.ndarray]], batch: int = 64) -> None:
        self.load, self.batch = load, batch

    def with_score(self, rows: DataFrame, query: str, document: str, to: str = "rerank_score") -> DataFrame:
        return _appended(rows, [query, document], to, T.DoubleType(), pa.float64(), self.load, self.batch, lambda model, q, d: np.asarray(model(q, d), np.float64))


def yes_no_reranker(load: Callable[[], Callable[[list[str], list[str]], tuple[np.ndarray, np.ndarray]]], batch: int = 64) -> Reranker:
    """A reranker from a model of (yes, no) logits: the probability of yes."""

    def load_scores() -> Callable[[list[str], list[str]], np.ndarray]:
        model = load()

        def score(queries: list[str], documents: list[str]) -> np.ndarray:
            yes, no = model(queries, documents)
            return 1 / (1 + np.exp(np.asarray(no, float) - np.asarray(yes, float)))

        return score

    return Reranker(load_scores, batch)


def overlap_reranker() -> Reranker:
    """Stand-in: share of the query's distinct words that the document has."""

    def load() -> Callable[[list[str], list[str]], np.ndarray]:
        def score(queries: list[str], documents: list[str]) -> np.ndarray:
            words = [(set(q.lower().split(" ")), set(d.lower().split(" "))) for q, d in zip(queries, documents, strict=True)]
            return np.array([len(q & d) / len(q) for q, d in words])

        return score

    return Reranker(load)


class Entailment:
    """Verdict 1 or 0 for (premise, claim); ``load`` returns a function from lists of both to raw outputs, and "1" means entailed."""

    def __init__(self, load: Callable[[], Callable[[list[str], list[str]], list[str]]], batch: int = 64) -> None:
        self.load, self.batch = load, batch

    def with_verdict(self, pairs: DataFrame, premise: str, claim: str) -> DataFrame:
        raw = _appended(pairs, [premise, claim], "joint_raw_output", T.StringType(), pa.string(), self.load, self.batch, lambda model, p, c: model(p, c))
        return raw.withColumn("joint_entailment", (F.trim("joint_raw_output") == "1").cast("int"))


def containment_entailment(share: float = 0.6) -> Entailment:
    """"1" if at least that share of the claim's words stand in the premise."""

    def load():
        def ask(premises: list[str], claims: list[str]) -> list[str]:
            out = []
            for p, c in zip(premises, claims, strict=True):
                words, have = set(c.lower().split()), set(p.lower().split())
                out.append("1" if words and len(words & have) / len(words) >= share else "0")
            return out

        return ask

    return Entailment(load)
