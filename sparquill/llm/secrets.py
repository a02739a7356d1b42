"""Secret scan: candidate strings, and a random forest that removes false positives.

Candidates are assigned values (password=..., token: "...") and long unbroken strings with digits.
The forest is trained here on labelled findings that :func:`labelled_findings` writes by rule, from
length, character transitions, dictionary coverage (by the words of a public tokenizer's vocabulary),
path and neighbouring words.
"""

from __future__ import annotations

import json
import math
import os
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.llm._runtime import read, sliced
from sparquill.llm.tokens import TOKENIZER

CUT = 0.5
TREES, DEPTH = 40, 9
_ASSIGNED = re.compile(r"(?i)(?:passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key)[\"']?\s{0,3}(?:=|:|=>)\s{0,3}[\"']?([^\s\"'<>,;]{6,})")
_LONG = re.compile(r"[A-Za-z0-9+/_=\-]{16,}")
_PEM = re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----")
_WORD = re.compile(r"[A-Za-z]{3,}")
_SECRET_WORDS = frozenset("password passwd pwd secret token key apikey auth credential credentials access private bearer aws login".split())
_HARMLESS_WORDS = frozenset("example sample test dummy placeholder sha sha1 sha256 md5 hash checksum commit revision digest uuid guid version isbn license integrity id build image layer".split())
#: Common English words that findings of the training table are made of.
_COMMON = tuple(
    """about access account admin after again change code come could data default demo early empty enter example false field file find first from
    general good great group hello here home house insert invalid license line local make model more name never none null number open order other
    page pass place please point private public right same sample school secret server should small some state still string system table test that
    their there these they thing this time true under user value very water welcome well were what when where which while with word work world would
    write year your letmein monkey dragon master""".split()
)
_PATH_TEST = re.compile(r"(?i)(test|spec|example|sample|mock|fixture|docs?/|readme|\.lock$|\.sum$|\.md$)")
_PATH_CODE = re.compile(r"(?i)(\.env|config|settings|\.ya?ml$|\.ini$|\.py$|\.js$|\.sh$|deploy|prod)")
N_FEATURES = 22


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of candidate strings, assigned values before long strings, none inside another."""
    out = [(*m.span(), "pem") for m in _PEM.finditer(text)] if "-----BEGIN" in text else []
    if "=" in text or ":" in text:
        out += [(*m.span(1), "assigned") for m in _ASSIGNED.finditer(text)]
    if any(d in text for d in "0123456789"):
        taken = sorted(out)
        for m in _LONG.finditer(text):
            a, b = m.span()
            own = m.group()
            if any(c.isdigit() for c in own) and any(c.isalpha() for c in own) and not any(x < b and a < y for x, y, _ in taken):
                out.append((a, b, "long"))
    return sorted(out)


@lru_cache(2)
def dictionary(name: str = TOKENIZER) -> frozenset[str]:
    """Words and word ends of four letters or more in a public tokenizer's vocabulary (a path, or a name of ``public_tokenizers``)."""
    if not os.path.isabs(name):
        import public_tokenizers

        name = public_tokenizers.path(name)
    with open(name, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    return frozenset(w for t in vocab if t.endswith("</w>") and len(w := t[:-4]) >= 4 and w.isascii() and w.isalpha())


def _class(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def features(value: str, before: str, after: str, path: str, kind: str) -> list[float]:
    n = len(value)
    classes = [_class(c) for c in value]
    share = [classes.count(k) / n for k in range(4)]
    moves = sum(a != b for a, b in zip(classes, classes[1:], strict=False)) / max(1, n - 1)
    letter_digit = sum({a, b} in ({0, 2}, {1, 2}) for a, b in zip(classes, classes[1:], strict=False)) / max(1, n - 1)
    counts = Counter(value)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    known = dictionary()
    covered = sum(len(w) for w in _WORD.findall(value) if w.lower() in known)
    vowels = sum(c in "aeiouAEIOU" for c in value) / max(1, sum(c.isalpha() for c in value))
    longest = max((len(w) for w in _WORD.findall(value)), default=0)
    near = {w.lower() for w in _WORD.findall(before[-40:]) + _WORD.findall(after[:24])}
    joined = before[-40:].lower()
    hexed = all(c in "0123456789abcdefABCDEF" for c in value)
    return [
        n, *share, moves, letter_digit, entropy, entropy / max(1.0, math.log2(n)), covered / n, vowels, longest / n, len(counts) / n,
        float(bool(near & _SECRET_WORDS) or any(w in joined for w in ("password", "token", "secret", "key"))), float(bool(near & _HARMLESS_WORDS)),
        float(bool(_PATH_TEST.search(path))), float(bool(_PATH_CODE.search(path))), float(hexed), float(hexed and n in (32, 40, 64)),
        float(kind == "assigned"), float(value.startswith(("AKIA", "ghp_", "sk_", "xox", "eyJ", "AIza"))), float(value.count("-") == 4 and n == 36),
    ]


def labelled_findings(n: int = 2400, seed: int = 5) -> list[tuple[str, str, str, str, str, int]]:
    """(value, before, after, path, kind, is_secret), written by rule."""
    r = random.Random(seed)
    pick = lambda alphabet, k: "".join(r.choice(alphabet) for _ in range(k))
    lower, digits, hexa = "abcdefghijklmnopqrstuvwxyz", "0123456789", "0123456789abcdef"
    full = lower + lower.upper() + digits
    words = sorted(_COMMON)

    def filler() -> str:
        return " ".join(pick("aeinorstdlhu", r.randint(2, 9)) for _ in range(r.randint(1, 5)))

    rows = []
    for _ in range(n):
        path = r.choice(["", "src1", "src12", "app/config.py", "deploy/prod.env", "tests/test_auth.py", "docs/readme.md", "poetry.lock", "settings.yaml", "notes"])
        before, after, kind = filler() + " ", " " + filler(), "long"
        secret = r.random() < 0.5
        if secret:
            how = r.randrange(7)
            if how == 0:
                value = "AKIA" + pick(lower.upper() + "234567", 16)
                before += r.choice(["", "", "aws key ", "access_key="])
            elif how in (1, 2):
                value, kind = pick(hexa, r.choice([18, 20, 24, 32, 40, 64])), "assigned"
                before += r.choice(["password=", 'token = "', "secret: ", 'api_key="', "pwd="])
            elif how == 3:
                value, kind = pick(full + "!#%+", r.randint(10, 24)), "assigned"
                before += r.choice(["password=", "passwd: ", 'password = "', "secret="])
            elif how == 4:
                value = r.choice(["ghp_", "sk_live_", "xoxb-", "AIza"]) + pick(full, 32)
            elif how == 5:
                value = pick(full, 40)
                before += r.choice(["aws_secret ", "token ", "bearer ", "auth key "])
            else:
                value = "eyJ" + pick(full, 30) + "." + pick(full, 24)
                value = value.replace(".", "-")
                before += r.choice(["bearer ", "token "])
        else:
            how = r.randrange(8)
            if how == 0:
                value = pick(hexa, r.choice([32, 40, 64]))
                before += r.choice(["sha256 ", "commit ", "md5 ", "checksum: ", "revision ", "integrity "])
            elif how == 1:
                value = "-".join(pick(hexa, k) for k in (8, 4, 4, 4, 12))
                before += r.choice(["uuid ", "id ", ""])
            elif how == 2:
                value, kind = r.choice(["changeme1", "password123", "your_token_here", "example-secret", "xxxxxxxxxxxx", "placeholder", "null_value", "********", "<password>"[1:-1] + "here", "test1234"]), "assigned"
                before += r.choice(["password=", "token: ", 'secret = "'])
            elif how == 3:
                value = "_".join(r.choice(words) for _ in range(r.randint(3, 5))) + r.choice(["", "1", "2024"])
                value += "" if any(c.isdigit() for c in value) else "7"
            elif how == 4:
                value, kind = r.choice(["os.environ[TOKEN]", "config.get(token)", "get_password()", "self.password", "settings.SECRET_KEY", "${TOKEN}"]), "assigned"
                before += r.choice(["password=", "token = ", "secret: "])
            elif how == 5:
                value = pick(lower, r.randint(12, 20)) + pick(digits, r.randint(1, 3))
            elif how == 6:
                value = r.choice(["", "v"]) + "-".join([r.choice(words), pick(digits, 4), r.choice(words), pick(digits, 2)]) + r.choice(words)
            else:
                value = pick("a", 1) * r.randint(8, 20) + pick("01", 8)
        rows.append((value, before, after, path, kind, int(secret)))
    return rows


def findings_table(spark: SparkSession, n: int = 2400, seed: int = 5) -> DataFrame:
    return spark.createDataFrame(labelled_findings(n, seed), "value string, before string, after string, path string, kind string, is_secret int")


class RandomForest:
    """Binary trees as flat arrays; prediction walks all rows of a batch level by level."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, seed: int = 3) -> None:
        self.n_trees, self.depth, self.seed = trees, depth, seed
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> RandomForest:
        """Bootstrap rows per tree, a random root-size subset of features per node, Gini gain over all cut points."""
        r = np.random.default_rng(self.seed)
        some = max(1, round(math.sqrt(x.shape[1])) + 1)
        for _ in range(self.n_trees):
            size = (2 << self.depth) - 1
            feature, cut, value = np.full(size, -1, np.int64), np.zeros(size), np.zeros(size)
            todo = [(0, r.integers(0, len(x), len(x)))]
            while todo:
                node, rows = todo.pop()
                own = y[rows]
                value[node] = own.mean()
                if 2 * node + 2 >= size or len(rows) < 4 or own.min() == own.max():
                    continue
                best = (1e-9, -1, 0.0)
                for f in r.choice(x.shape[1], some, replace=False):
                    order = np.argsort(x[rows, f], kind="stable")
                    v, t = x[rows[order], f], own[order]
                    at = np.flatnonzero(v[1:] > v[:-1]) + 1
                    if not len(at):
                        continue
                    ones, n = np.cumsum(t)[at - 1], len(t)
                    p, q = ones / at, (t.sum() - ones) / (n - at)
                    gain = own.mean() * (1 - own.mean()) - (at * p * (1 - p) + (n - at) * q * (1 - q)) / n
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), int(f), float((v[at[k]] + v[at[k] - 1]) / 2))
                if best[1] < 0:
                    continue
                feature[node], cut[node] = best[1], best[2]
                right = x[rows, best[1]] > best[2]
                todo += [(2 * node + 1, rows[~right]), (2 * node + 2, rows[right])]
            self.trees.append((feature, cut, value))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        total, at = np.zeros(len(x)), np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                node = np.where(f >= 0, 2 * node + 1 + (x[at, f] > cut[node]), node)
            total += value[node]
        return total / max(1, len(self.trees))


@lru_cache(4)
def trained(n: int = 2400, seed: int = 5) -> RandomForest:
    rows = labelled_findings(n, seed)
    return RandomForest().fit(np.array([features(*r[:5]) for r in rows]), np.array([r[5] for r in rows]))


def secrets(docs: DataFrame, forest: RandomForest | None = None, cut: float = CUT, path: str | None = "source") -> DataFrame:
    """``docs(doc_id, text[, path])`` to ``(doc_id, n_candidates, n_secrets, findings)``, one row per input row, no shuffle.

    ``findings`` hold every candidate: start, end (code points, end exclusive), kind, score and whether it
    is a secret (score of at least ``cut``; PEM private keys always).  Null and empty texts have none.
    Repeated rows each get a row, ids are not looked at; without a ``path`` column paths are empty; other
    extra columns are ignored; an empty table gives an empty result.
    """
    forest = forest or trained()
    struct = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("score", pa.float64()), ("secret", pa.bool_())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 4 << 20):
            texts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            found = [candidates(t) if t else [] for t in texts]
            rows = [features(t[a:b], t[max(0, a - 40) : a], t[b : b + 24], p or "", kind) for t, p, own in zip(texts, paths, found, strict=True) for a, b, kind in own]
            scores = iter(forest.predict(np.array(rows)).tolist() if rows else ())
            out = []
            for own in found:
                scored = [(a, b, kind, 1.0 if kind == "pem" else s) for (a, b, kind), s in ((c, next(scores)) for c in own)]
                out.append([{"start": a, "end": b, "kind": kind, "score": s, "secret": s >= cut} for a, b, kind, s in scored])
            n = [len(o) for o in out]
            hits = [sum(f["secret"] for f in o) for o in out]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(hits, pa.int64()), pa.array(out, struct)], names=["doc_id", "n_candidates", "n_secrets", "findings"])

    where = F.col(f"`{path}`").cast("string") if path in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), where.alias("path"))
    return rows.mapInArrow(scan, "doc_id long, n_candidates long, n_secrets long, findings array<struct<start:long,end:long,kind:string,score:double,secret:boolean>>")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(read(spark, sf_dir, "documents"))
