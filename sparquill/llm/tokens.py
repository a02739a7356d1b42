"""Exact token ids through a cache of white-space-delimited words.

The tokenizer's pre-tokens never span white space and its normaliser works character by
character or within a word, so the ids of a text are the ids of its words in a row.  Each
distinct lower-cased word is encoded once per worker by the real tokenizer; texts with characters
that Python splits or lowers differently, or with special tokens, go to the tokenizer whole.
"""

from __future__ import annotations

import os
import re
from itertools import repeat

import numpy as np

from sparquill.llm._runtime import cuts

TOKENIZER = "word_bpe_49k.json"
#: Characters of a text whose words are held at once.
PIECE = 1 << 20
#: New words that are encoded as they are; more are put together first.
FEW = 8
#: Separators only Python splits at, letters it lowers by context, and the start of special tokens.
_ODD = re.compile("[\x1c-\x1fΣİ]|<\\|")


class CachedTokenizer:
    """Encodes batches of texts to flat uint32 ids; ``most`` bounds the cached words."""

    def __init__(self, name: str = TOKENIZER, most: int = 600_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        if not os.path.isabs(name):
            import public_tokenizers

            name = public_tokenizers.path(name)
        self.tokenizer = Tokenizer.from_file(name)
        self.most = most
        vocab = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocab.values()) + 1, bool)
        self.is_end[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _put(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        """Add new words whose ids stand in a row, each ending at its ``ends``."""
        n, total = len(self.index), self.used + len(ids)
        if total > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty(max(total, len(self.ids)), np.uint32)))
        if n + len(words) >= len(self.ends):
            self.ends = np.concatenate((self.ends, np.zeros(max(n + len(words), len(self.ends)), np.int64)))
        self.ids[self.used : total] = ids
        self.ends[n + 1 : n + 1 + len(words)] = self.used + ends
        self.used = total
        self.index.update(zip(words, range(n, n + len(words)), strict=True))

    def _put_each(self, words: list[str]) -> None:
        own = self._encoded(words)
        self._put(words, np.array([i for x in own for i in x], np.uint32), np.cumsum([len(x) for x in own]))

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, words: list[str]) -> None:
        """Words of letters are encoded many to a text and told apart by their word-end tokens."""
        index = self.index
        stopped = [w for w in words if w[-1] in ",." and w[:-1].isalpha()]
        letters = list(dict.fromkeys(x for w in words if (x := w[:-1] if w[-1] in ",." else w).isalpha() and x not in index))
        for at in range(0, len(letters), 256):
            chunk = letters[at : at + 256]
            ids = np.array(self._encoded([" ".join(chunk)])[0], np.uint32)
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) == len(chunk) and ends[-1] == len(ids):
                self._put(chunk, ids, ends)
            else:
                self._put_each(chunk)
        for stop in ",.":
            own = [w for w in stopped if w[-1] == stop]
            if own:
                tail = np.array(self._encoded([stop])[0], np.uint32)
                base = np.fromiter((index[w[:-1]] for w in own), np.int64, len(own))
                size = self.ends[base + 1] - self.ends[base]
                ends = np.cumsum(size + len(tail))
                take = np.repeat(self.ends[base] - (ends - size - len(tail)), size + len(tail)) + np.arange(ends[-1])
                ids = self.ids[np.minimum(take, self.used - 1)]
                for k in range(len(tail)):
                    ids[ends - len(tail) + k] = tail[k]
                self._put(own, ids, ends)
        rest = [w for w in words if w not in index]
        for at in range(0, len(rest), 10_000):
            self._put_each(rest[at : at + 10_000])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, length of each); null counts as empty; the words of a long text are held piece by piece."""
        if any(text and len(text) > PIECE for text in texts):
            parts = [[self._encode([piece])[0] for piece in cuts(text or "", PIECE)] for text in texts]
            return np.concatenate([p for own in parts for p in own]), np.array([sum(map(len, own)) for own in parts], np.int64)
        return self._encode(texts)

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """Length of each text's ids, without the ids; the words of a long text are held piece by piece."""
        if any(text and len(text) > PIECE for text in texts):
            return np.array([sum(int(self._counts([piece])[0]) for piece in cuts(text or "", PIECE)) for text in texts], np.int64)
        return self._counts(texts)

    def _counts(self, texts: list[str | None]) -> np.ndarray:
        words, counts, whole = self._words(texts)
        at = self._numbers(words)
        before = np.zeros(len(words) + 1, np.int64)
        (self.ends[at + 1] - self.ends[at]).cumsum(out=before[1:])
        bounds = np.zeros(len(texts) + 1, np.int64)
        counts.cumsum(out=bounds[1:])
        own = before[bounds]
        lengths = own[1:] - own[:-1]
        for i, ids in whole.items():
            lengths[i] = len(ids)
        return lengths

    def _words(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, dict[int, np.ndarray]]:
        """Words of the texts in a row, how many each has, and the ids of texts that are encoded whole."""
        words: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        whole: dict[int, np.ndarray] = {}
        for i, text in enumerate(texts):
            if text:
                if _ODD.search(text):
                    whole[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                    continue
                own = text.lower().split()
                counts[i] = len(own)
                words += own
        return words, counts, whole

    def _numbers(self, words: list[str]) -> np.ndarray:
        """Where the words stand in the cache; new ones are added."""
        if len(self.index) > self.most:
            self._clear()
        index = self.index
        at = np.fromiter(map(index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = [words[k] for k in missing.tolist()]
            distinct = list(dict.fromkeys(new))
            (self._put_each if len(distinct) <= FEW else self._add)(distinct)
            at[missing] = np.fromiter(map(index.__getitem__, new), np.int64, len(new))
        return at

    def _encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        words, counts, whole = self._words(texts)
        at = self._numbers(words)
        first, size = self.ends[at], self.ends[at + 1] - self.ends[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.ids[np.repeat(first - (ends - size), size) + np.arange(total)]
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
        lengths = np.diff(bounds)
        if whole:
            pieces = [whole.get(i, flat[bounds[i] : bounds[i + 1]]) for i in range(len(texts))]
            flat, lengths = np.concatenate(pieces), np.array([len(p) for p in pieces], np.int64)
        return flat, lengths


_cached: dict[str, CachedTokenizer] = {}


def tokenizer(name: str = TOKENIZER) -> CachedTokenizer:
    """The worker's tokenizer of that name; its word cache lives as long as the worker."""
    if name not in _cached:
        _cached[name] = CachedTokenizer(name)
    return _cached[name]
