"""Personal data: fixed patterns, and a linear-chain conditional random field that adds spans.

The patterns (email, IP address, payment card, phone) are checked (octets, Luhn sum, digit
counts) and always kept.  The field labels tokens B/I per kind from word-shape features of the
token and its neighbours.  It is trained here, from a small labelled table that
:func:`training_rows` writes by rule, and decoded by Viterbi in padded numpy batches.  A span of any
kind holds a digit, an ``@`` or a spelled-out "at"/"dot"; a chain is the whole neighbourhood of such
tokens, however long, in training as in use.  Work and memory are linear in the text.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.llm._runtime import read, sliced, text_columns

KINDS = ("email", "ip", "card", "phone")
STATES = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
#: The domain of an email, an IP address, a card, a phone number.  Digit runs are taken whole: no match can start inside one.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\w\s]|[^\W_]|_")
_SPELLED = re.compile(r"[(\[{<]\s?(?:at|dot)\s?[)\]}>]|\sdot\s", re.IGNORECASE)
_TRIGGER = re.compile(r"[0-9]+|@|[(\[{<]\s?(?:at|dot)\s?[)\]}>]|(?<=\s)dot(?=\s)", re.IGNORECASE)
#: Characters around a trigger that its neighbourhood holds, moved out to token ends.
REACH = 48
#: Tokens whose features are held at once, and scores of a batch of chains, padded.
PIECE, PADDED = 4096, 1 << 16


# --- fixed patterns -------------------------------------------------------------------------
def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _holds(kind: int, found: str) -> bool:
    if kind == 0:
        return True
    if kind == 1:
        return all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in found.split("."))
    digits = _NOT_DIGIT.sub("", found)
    return 16 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 8 <= len(digits) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping emails: from each ``@`` to the left over local characters, to the right over a domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def has_digit(text: str) -> bool:
    return any(d in text for d in "0123456789")


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(kind, start, end) of what the patterns find and the checks keep, and of what they drop."""
    kept, dropped = [(0, a, b) for a, b in emails(text)], []
    if has_digit(text):
        for kind, pattern, need in ((1, _IP, "."), (2, _CARD, ""), (3, _PHONE, "+")):
            if need in text:
                for m in pattern.finditer(text):
                    (kept if _holds(kind, m.group()) else dropped).append((kind, *m.span()))
    return kept, dropped


# --- features -------------------------------------------------------------------------------
def neighbourhoods(text: str) -> Iterator[list[tuple[int, int]]]:
    """Token (start, end) lists around triggers; overlapping neighbourhoods are one."""
    at = 0
    runs: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        lo, hi = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = hi
        else:
            runs.append([lo, hi])
    for lo, hi in runs:
        if hi <= at:  # within the unbroken text that the last one was moved out to
            continue
        while lo > at and not text[lo - 1].isspace():
            lo -= 1
        while hi < len(text) and not text[hi].isspace():
            hi += 1
        yield [m.span() for m in _TOKEN.finditer(text, max(lo, at), hi)]
        at = hi


def shape(token: str) -> str:
    """Case pattern or digit count of a token; punctuation stands for itself."""
    return _shape(token if len(token) <= 24 else token[:24] + token[-1] if token.isdecimal() else _brief(token))


def _brief(token: str) -> str:
    """A short token of the same shape."""
    return "aaaa" if token.islower() else "AAAA" if token.isupper() else "Aaaa" if token.istitle() else "aAaa" if token[0].isalpha() else token[0]


@lru_cache(65536)
def _shape(token: str) -> str:
    if token.isdecimal():
        return f"d{min(len(token), 20)}" + ("<256" if len(token) <= 3 and int(token) < 256 else "")
    if not token[0].isalpha():
        return token
    case = "a" if token.islower() else "A" if token.isupper() else "Aa" if token.istitle() else "aA"
    return case + ("1" if len(token) == 1 else "2" if len(token) <= 3 else "4")


_CUES = frozenset("at dot com org net de fr es edu io email mail tel phone call fax card visa ip host version".split())


def features(text: str, tokens: list[tuple[int, int]], begin: int = 0, end: int | None = None) -> list[list[str]]:
    """Features of the chain's tokens from ``begin`` to ``end``."""
    end = len(tokens) if end is None else min(end, len(tokens))
    low, high = max(0, begin - 2), min(len(tokens), end + 2)
    words = [text[a:b] if b - a < 4096 else text[a : a + 4095] + text[b - 1] for a, b in tokens[low:high]]
    edge = lambda marks, n: marks[len(marks) - n :] if n else []
    shapes = [*edge(["<<", "<"], 2 - (begin - low)), *map(shape, words), *[">", ">>"][: 2 - (high - end)]]
    cues = [*edge(["", ""], 2 - (begin - low)), *(w.lower() if len(w) < 10 and w.lower() in _CUES else "" for w in words), "", ""]
    glued = [k > 0 and tokens[k - 1][1] == tokens[k][0] for k in range(begin, end)] + [end < len(tokens) and tokens[end - 1][1] == tokens[end][0]]
    return [
        [
            "0" + shapes[k + 2], "-" + shapes[k + 1], "+" + shapes[k + 3], "=" + shapes[k] + " " + shapes[k + 1], "#" + shapes[k + 3] + " " + shapes[k + 4],
            "b" + shapes[k + 1] + " " + shapes[k + 2], "f" + shapes[k + 2] + " " + shapes[k + 3], f"g{glued[k]}{glued[k + 1]}", "c" + cues[k + 2], "p" + cues[k + 1], "n" + cues[k + 3], f"s{glued[k]}{shapes[k + 2]}",
        ]
        for k in range(end - begin)
    ]


# --- the labelled table ---------------------------------------------------------------------
def training_rows(n: int = 400, seed: int = 11) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """(text, [(kind, start, end)]): filler words around personal data in many notations, and look-alikes."""
    r = random.Random(seed)

    def word(lo: int = 2, hi: int = 9) -> str:
        w = "".join(r.choice("abcdefghiklmnoprstuvwzéñö") for _ in range(r.randint(lo, hi)))
        return w if r.random() < 0.8 else w.capitalize() if r.random() < 0.8 else w.upper()

    def num(k: int) -> str:
        return "".join(r.choice("0123456789") for _ in range(k))

    def name() -> str:
        return "".join(r.choice("abcdefghiklmnoprstuvwz") for _ in range(r.randint(3, 9)))

    def email() -> str:
        user = name() + r.choice(["", "." + name(), "." + num(2), num(2), "_" + name()])
        host = name() + r.choice(["", num(1)])
        end = r.choice(["com", "org", "net", "example.com", "de", "edu"])
        how = r.randrange(5)
        if how < 3:
            return f"{user}@{host}.{end}"
        if how == 3:
            a, d = r.choice([("(at)", "(dot)"), ("[at]", "[dot]"), ("{at}", "{dot}")])
            return f"{name()} {a} {host} {d} {end.split('.')[0]}"
        return f"{name()} at {host} dot {end.split('.')[0]}"

    def ip() -> str:
        return ".".join(str(r.randrange(256)) for _ in range(4))

    def card() -> str:
        d = num(15)
        d += next(c for c in "0123456789" if luhn(d + c))
        sep = r.choice(["", "", " ", "-", "."])
        return sep.join(d[k : k + 4] for k in range(0, 16, 4))

    def phone() -> str:
        a, b, c = num(3), num(3), num(4)
        return r.choice([f"+1 ({a}) {b}-{c}", f"+{num(2)} {num(3)} {num(7)}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+1 {a} {b} {c}", f"+1-{a}-{b}-{c}"])

    def other() -> str:
        return r.choice(
            [
                f"version {num(1)}", f"CC BY-NC {num(1)}.0", f"{r.randrange(1900, 2030)}", f"{num(2)}%", f"{num(2)}.{num(2)}", f"${num(3)}.{num(2)}", f"{r.randrange(1900, 2030)}-0{num(1)}-1{num(1)}", f"1{num(1)}:{num(2)}",
                "AKIA" + "".join(r.choice("ABCDEFGHJKLMNPQRSTUVWXYZ234567") for _ in range(16)), f'token = "{"".join(r.choice("0123456789abcdef") for _ in range(40))}"', f"password={''.join(r.choice('0123456789abcdef') for _ in range(18))}",
                f"v{num(1)}.{num(1)}.{num(2)}", num(r.randint(1, 7)), f"{word()} dot {word()}", f"{word()}@", f"#{num(4)}", f"{num(1)},{num(3)},{num(3)}", f"{num(3)}-{num(2)}", f"({num(2)})", f"No. {num(5)}",
            ]
        )

    rows = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(r.randint(1, 3)):
            text += " ".join(word() for _ in range(r.randint(1, 8))) + r.choice([" ", " ", ", ", "\n"])
            kind = r.choice([0, 1, 2, 3, 4, 4, 4])
            if kind == 4:
                text += other()
            else:
                cue = {0: ["email ", "mail: "], 1: ["ip ", "host "], 2: ["card ", "visa "], 3: ["tel ", "phone: ", "call "]}[kind]
                text += r.choice(["", "", r.choice(cue)])
                value = (email, ip, card, phone)[kind]()
                spans.append((kind, len(text), len(text) + len(value)))
                text += value
            text += r.choice([" ", " ", ". ", ", "])
        rows.append((text + " ".join(word() for _ in range(r.randint(0, 6))), spans))
    return rows


def training_table(spark: SparkSession, n: int = 400, seed: int = 11) -> DataFrame:
    rows = [(t, [(KINDS[k], a, b) for k, a, b in s]) for t, s in training_rows(n, seed)]
    return spark.createDataFrame(rows, "text string, spans array<struct<kind:string,start:int,end:int>>")


# --- the field ------------------------------------------------------------------------------
class Crf:
    """Weights of a linear-chain field over :data:`STATES`; unknown features count nothing."""

    def __init__(self, names: dict[str, int]) -> None:
        s = len(STATES)
        self.names = names
        self.emit = np.zeros((len(names) + 1, s))  # the last row stays zero: unknown or padding
        self.trans = np.zeros((s, s))
        banned = np.zeros((s, s), bool)
        for k in range(len(KINDS)):
            banned[:, 2 + 2 * k] = True
            banned[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = False
        self.banned = np.where(banned, -1e4, 0.0)
        self.first = np.array([-1e4 if x.startswith("I") else 0.0 for x in STATES])

    def index(self, chains: list[list[list[str]]]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(c) for c in chains])
        out = np.full((len(chains), int(lengths.max()), 12), len(self.names), np.int64)
        get, none = self.names.get, len(self.names)
        for k, chain in enumerate(chains):
            out[k, : len(chain)] = [[get(f, none) for f in token] for token in chain]
        return out, lengths

    def emissions(self, text: str, tokens: list[tuple[int, int]]) -> np.ndarray:
        """Score of every state at every token of a chain, worked out piece by piece."""
        out = []
        for at in range(0, len(tokens), PIECE):
            idx, _ = self.index([features(text, tokens, at, at + PIECE)])
            out.append(self.emit[idx[0]].sum(axis=1))
        return np.concatenate(out)

    def viterbi(self, chains: list[np.ndarray]) -> list[np.ndarray]:
        """Best state sequence of every chain of state scores, all chains of the batch at once."""
        lengths = np.array([len(c) for c in chains])
        trans = self.trans + self.banned
        n, t, s = len(chains), int(lengths.max()), len(STATES)
        scores = np.zeros((n, t, s))
        for k, chain in enumerate(chains):
            scores[k, : len(chain)] = chain
        best = scores[:, 0] + self.first
        back = np.zeros((n, t, s), np.int8)
        for k in range(1, t):
            step = best[:, :, None] + trans
            back[:, k] = step.argmax(axis=1)
            new = step.max(axis=1) + scores[:, k]
            best = np.where((k < lengths)[:, None], new, best)
        out = []
        for c in range(n):
            state = int(best[c].argmax())
            path = np.zeros(lengths[c], np.int64)
            for k in range(lengths[c] - 1, -1, -1):
                path[k] = state
                state = int(back[c, k, state])
            out.append(path)
        return out

    def fit(self, chains: list[list[list[str]]], labels: list[list[int]], rounds: int = 70, rate: float = 0.12, decay: float = 1e-3) -> Crf:
        """Maximum likelihood by Adam over all chains at once, scaled forward-backward."""
        idx, lengths = self.index(chains)
        n, t = idx.shape[:2]
        live = np.arange(t) < lengths[:, None]
        gold = np.zeros((n, t), np.int64)
        for k, own in enumerate(labels):
            gold[k, : len(own)] = own
        s = len(STATES)
        hot = np.eye(s)[gold] * live[..., None]
        hot_t = np.einsum("nts,ntu->su", hot[:, :-1], hot[:, 1:])
        flat = idx.reshape(-1)
        by_feature = np.argsort(flat, kind="stable")
        heads = np.flatnonzero(np.diff(flat[by_feature], prepend=-1))
        token = by_feature // idx.shape[2]
        moment = [np.zeros_like(self.emit), np.zeros_like(self.trans)]
        second = [np.zeros_like(self.emit), np.zeros_like(self.trans)]

        start = np.exp(self.first)
        for step in range(1, rounds + 1):
            scores = self.emit[idx].sum(axis=2)
            like = np.exp(scores - scores.max(axis=2, keepdims=True))
            hop = np.exp(self.trans + self.banned)
            alpha, beta, norm = np.zeros((n, t, s)), np.ones((n, t, s)), np.ones((n, t, 1))
            for k in range(t):
                new = like[:, k] * (alpha[:, k - 1] @ hop if k else start)
                size = new.sum(axis=1, keepdims=True)
                alpha[:, k] = np.where(live[:, k, None], new / size, alpha[:, k - 1])
                norm[:, k] = np.where(live[:, k, None], size, 1.0)
            for k in range(t - 2, -1, -1):
                new = (like[:, k + 1] * beta[:, k + 1] / norm[:, k + 1]) @ hop.T
                beta[:, k] = np.where(live[:, k + 1, None], new, 1.0)
            post = alpha * beta * live[..., None]
            into = (like * beta / norm * live[..., None])[:, 1:]
            pairs = alpha[:, :-1].reshape(-1, s).T @ into.reshape(-1, s) * hop
            grad_e = np.zeros_like(self.emit)
            grad_e[flat[by_feature][heads]] = np.add.reduceat((post - hot).reshape(-1, s)[token], heads, axis=0)
            grads = [grad_e / n + decay * self.emit, (pairs - hot_t) / n + decay * self.trans]
            for w, g, m, v in zip((self.emit, self.trans), grads, moment, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            self.emit[-1] = 0
        return self


def _labels(tokens: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[int]:
    out = [0] * len(tokens)
    for kind, a, b in spans:
        own = [k for k, (x, y) in enumerate(tokens) if x >= a and y <= b]
        for k in own:
            out[k] = 1 + 2 * kind + (k != own[0])
    return out


@lru_cache(4)
def trained(n: int = 400, seed: int = 11) -> Crf:
    """The field fitted to the labelled table; the same weights for the same arguments."""
    chains, labels = [], []
    for text, spans in training_rows(n, seed):
        for tokens in neighbourhoods(text):
            if tokens:
                chains.append(features(text, tokens))
                labels.append(_labels(tokens, spans))
    names: dict[str, int] = {}
    for chain in chains:
        for token in chain:
            for f in token:
                names.setdefault(f, len(names))
    return Crf(names).fit(chains, labels)


def _plausible(kind: int, text: str) -> bool:
    """A span of the field must have what its kind cannot do without."""
    digits = len(_NOT_DIGIT.sub("", text))
    if kind == 0:
        return "@" in text or _SPELLED.search(text) is not None
    if kind == 1:
        return _holds(1, text) if text.count(".") == 3 and digits else False
    if kind == 2:
        return 16 <= digits <= 19 and luhn(_NOT_DIGIT.sub("", text))
    return 10 <= digits <= 15


class _Taken:
    """Character ranges, asked whether a span meets one."""

    def __init__(self, spans: list[tuple[int, int]]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        k = bisect_left(self.starts, b) - 1
        return k >= 0 and self.ends[k] > a


def _decoded(path: list[int], tokens: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of the labelled runs of a chain."""
    t = 0
    while t < len(path):
        kind, first = path[t] // 2, t
        odd = path[t] % 2
        t += 1
        if odd:
            while t < len(path) and path[t] == 2 + 2 * kind:
                t += 1
            yield kind, tokens[first][0], tokens[t - 1][1]


def find(texts: list[str | None], crf: Crf) -> list[tuple[list, list]]:
    """(base spans, spans the field adds) per text; added spans overlap no kept one and no match of their own kind that the checks dropped."""
    out: list[tuple[list, list]] = []
    chains, owner = [], []
    for k, text in enumerate(texts):
        text = text or ""
        kept, dropped = base_spans(text)
        out.append((kept, []))
        if "@" in text or has_digit(text) or _SPELLED.search(text):
            taken = [_Taken([(a, b) for j, a, b in (*kept, *(d for d in dropped if d[0] == kind))]) for kind in range(len(KINDS))]
            for tokens in neighbourhoods(text):
                if tokens:
                    chains.append(crf.emissions(text, tokens))
                    owner.append((k, tokens, taken))
    order = sorted(range(len(chains)), key=lambda c: len(chains[c]))
    at = 0
    while at < len(order):
        stop = at + 1
        while stop < len(order) and (stop + 1 - at) * len(chains[order[stop]]) <= PADDED:
            stop += 1
        part = order[at:stop]
        at = stop
        for c, path in zip(part, crf.viterbi([chains[c] for c in part]), strict=True):
            k, tokens, taken = owner[c]
            for kind, a, b in _decoded(path.tolist(), tokens):
                if not taken[kind].meets(a, b) and _plausible(kind, (texts[k] or "")[a:b]):
                    out[k][1].append((kind, a, b))
    return out


_DDL = "doc_id long, base array<struct<kind:int,start:int,end:int>>, added array<struct<kind:int,start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def personal_data(docs: DataFrame, crf: Crf | None = None) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, base, added)``, one row per input row, no shuffle.

    Offsets are code points, ends exclusive; kinds index :data:`KINDS`; spans are sorted by kind and
    start.  Null and empty texts have none.  Repeated rows each get a row; ids are not looked at; extra
    columns are ignored; an empty table gives an empty result.
    """
    crf = crf or trained()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 4 << 20):
            found = find(batch.column(1).to_pylist(), crf)
            cols = [pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in sorted(f[k])] for f in found], _SPANS) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["doc_id", "base", "added"])

    rows = text_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(scan, _DDL)


def redact(text: str | None, crf: Crf) -> str | None:
    """The text with every span replaced by its kind in angle brackets; null stays null."""
    if not text:
        return text
    base, added = find([text], crf)[0]
    out, at = [], 0
    for kind, a, b in sorted(base + added, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind]}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, crf: Crf | None = None) -> DataFrame:
    """All columns of ``docs`` as they are, ``text`` redacted and ``n_chars`` (if there) counted anew.

    One row per input row, repeated rows too; null texts stay null, empty ones empty; an empty table stays empty.
    """
    crf = crf or trained()
    names = docs.columns
    at = names.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 4 << 20):
            cols = list(batch.columns)
            cols[at] = pa.array([redact(t, crf) for t in cols[at].to_pylist()], cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    out = docs.mapInArrow(scan, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out


def _joined(spans) -> F.Column:
    kind = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kind, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(read(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    count = [of(k).alias(f"n_{n}") for k, n in enumerate(KINDS)]
    return found.select("doc_id", *count, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.array_sort(F.concat("base", "added"))).alias("spans"))


def digest(spans: list[tuple[int, int, int]]) -> str:
    """``base_sha256`` of a list of spans, for tests."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans)).encode()).hexdigest()
