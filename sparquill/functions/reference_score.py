"""How much a text looks like a bibliography, and heading predicates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparquill.functions.text import PUNCTUATION, WORD_PATTERN, clean_passage, col, count_words, let, punctuation_share, words

# --- fixed values: patterns, headings and weights (in hundredths) of the data model -----------
REFERENCE_HEADINGS = "references|bibliography|literature cited|works cited|reference list"
DOI = r"(?i)\bdoi\b|10\.\d{4,9}/[-._;()/:A-Za-z0-9]+"
URL = r"(?i)https?://|www\."
ET_AL = r"(?i)\bet al\.?"
YEAR = r"\b(?:19|20)\d{2}\b"
BRACKETS = r"(?U)\[[0-9,\s\-]+\]"
JOURNALS = (
    "journal", "j\\.", "bmj", "jama", "lancet", "nejm", "annals", "ann", "chest", "radiology", "gastroenterology", "neurology", "circulation",
    "pediatrics", "surgery", "clinical", "clin", "medicine", "med", "nursing", "pharmacology", "intensive care", "emergency medicine",
    "rheumatology", "oncology", "surg", "obstet", "gynecol", "anesth", "analg",
)
JOURNAL = rf"(?i)\b({'|'.join(JOURNALS)})\b"
AUTHOR = r"[A-Z][a-z]+(?:\s+[A-Z][a-z]+)?\s+[A-Z]\.?"
AUTHORS = rf"\b{AUTHOR}(?:,\s*{AUTHOR})+"
SECTION_HEADINGS = (
    "abstract", "background", "introduction", "methods", "methodology", "recommendations", "recommendation", "diagnosis", "treatment", "management",
    "monitoring", "follow-up", "follow up", "prevention", "discussion", "conclusion", "conclusions", "summary", "key recommendations",
    "practice recommendations", "guideline", "guidelines", "overview", "scope", "results", "evidence", "clinical question", "clinical questions",
)
NUMBERED_HEADING = r"(?U)^\d+(\.\d+)*\.?\s+[A-Z][A-Za-z ,/\-:]{2,100}$"
THRESHOLD = 0.75
# ---------------------------------------------------------------------------------------------


def _n(s: Column, pattern: str) -> Column:
    return F.regexp_count(s, F.lit(pattern))


def reference_score(c: Column | str) -> Column:
    """0 to 1, higher for bibliographies; an empty text scores 1.  Summed in whole hundredths."""

    def facts(s: Column) -> Column:
        doi = F.when(s.contains("10.") | F.lower(s).contains("doi"), _n(s, DOI)).otherwise(0)
        years = F.when(s.contains("19") | s.contains("20"), _n(s, YEAR)).otherwise(0)
        return F.struct(F.greatest(count_words(s), F.lit(1)).alias("words"), doi.alias("doi"), years.alias("years"), F.lower(s).alias("low"))

    return let(clean_passage(c), lambda s: F.when(F.length(s) == 0, 1.0).otherwise(let(facts(s), lambda n: _points(s, n))))


def _points(s: Column, n: Column) -> Column:
    """Rare patterns are looked for only where a plain part of theirs occurs."""
    low = n["low"]
    rules = (
        (n["doi"] >= 1, 35),
        (n["doi"] >= 2, 25),
        ((low.contains("http") | low.contains("www.")) & s.rlike(URL), 20),
        (low.contains("et al") & s.rlike(ET_AL), 25),
        (n["years"] >= 3, 20),
        (n["years"] >= 5, 15),
        (s.contains("[") & (_n(s, BRACKETS) >= 3), 20),
        (s.rlike(JOURNAL), 15),
        (s.contains(",") & s.rlike(AUTHORS), 30),
        ((n["words"] < 180) & (punctuation_share(s) > 0.12), 15),
        ((n["words"] < 120) & (n["years"] >= 3), 15),
    )
    total = F.lit(0)
    for holds, points in rules:
        total = total + F.when(holds, points).otherwise(0)
    return F.least(total, F.lit(100)) / 100.0


#: Letters other than ASCII ones that equal an ASCII letter where case is ignored.
_FOLDED = re.compile("[\u0130\u0131\u017f\u212a]")
_WORD_CHARS = frozenset(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_TO_WORDS = bytes(c if c in _WORD_CHARS else 32 for c in range(256))
_TO_LINES = bytes(10 if c == 10 else b for c, b in enumerate(_TO_WORDS))
_TO_RUNS = bytes(c if c in _WORD_CHARS or c == ord("_") else 32 for c in range(256))
_ONE_WORD = frozenset(j.encode() for j in JOURNALS if j.isalpha())
#: Begins of the other journal names.
_OTHER = tuple(j.replace("\\", "") for j in JOURNALS if not j.isalpha())
_LISTED = re.compile(r",\s*[A-Z][a-z]")


def _runs(s: str) -> int:
    """Runs of the word pattern's characters that hold a letter or digit; what is not ASCII ends a run."""
    return len(s.encode("ascii", "replace").translate(_TO_WORDS, b"'-").split())


class _Beyond(dict):
    """Words of a token by the pattern less its runs; tokens met often are counted once."""

    def __init__(self, pattern: re.Pattern) -> None:
        super().__init__()
        self.pattern = pattern

    def __missing__(self, token: str) -> int:
        n = len(self.pattern.findall(token)) - _runs(token)
        if len(token) <= 32:
            if len(self) >= 100_000:
                self.clear()
            self[token] = n
        return n


class Bibliography:
    """The same score for texts at hand, for steps that go through a document in turn."""

    def __init__(self) -> None:
        self.found = {name: re.compile(p.replace("(?U)", "")) for name, p in (("doi", DOI), ("url", URL), ("et_al", ET_AL), ("year", YEAR), ("brackets", BRACKETS), ("journal", JOURNAL), ("authors", AUTHORS), ("word", WORD_PATTERN))}
        self.beyond = _Beyond(self.found["word"])

    def count(self, name: str, s: str) -> int:
        return sum(1 for _ in self.found[name].finditer(s))

    def words(self, s: str) -> int:
        """Matches of the word pattern: runs, which only tokens with an underscore or beyond ASCII can have more or less of."""
        return _runs(s) + self._beyond(s)

    def words_each(self, texts: list[str]) -> list[int]:
        """:meth:`words` of many texts, each in one line."""
        lines = "\n".join(texts).encode("ascii", "replace").translate(_TO_LINES, b"'-").split(b"\n") if texts else []
        return [len(line.split()) + self._beyond(s) for line, s in zip(lines, texts, strict=True)]

    def _beyond(self, s: str) -> int:
        if s.isascii() and "_" not in s:
            return 0
        return sum(map(self.beyond.__getitem__, [t for t in s.split() if not t.isascii() or "_" in t]))

    def journal(self, s: str, low: str) -> bool:
        """The pattern is looked for only where a run of word characters, or a plain part, is a journal's."""
        may = not _ONE_WORD.isdisjoint(low.encode("ascii", "replace").translate(_TO_RUNS).split()) or any(o in low for o in _OTHER)
        return (may or not s.isascii() and _FOLDED.search(s) is not None) and self.found["journal"].search(s) is not None

    def score(self, s: str, words: int | None = None) -> float:
        """Of a text in one line; ``words`` is its word count where that is known."""
        if not s:
            return 1.0
        low, n = s.lower(), max(1, self.words(s) if words is None else words)
        doi = self.count("doi", s) if "10." in s or "doi" in low else 0
        years = self.count("year", s) if "19" in s or "20" in s else 0
        points = 35 * (doi >= 1) + 25 * (doi >= 2) + 20 * (years >= 3) + 15 * (years >= 5) + 15 * (n < 120 and years >= 3)
        points += 20 if ("http" in low or "www." in low) and self.found["url"].search(s) else 0
        points += 25 if "et al" in low and self.found["et_al"].search(s) else 0
        points += 20 if "[" in s and self.count("brackets", s) >= 3 else 0
        points += 15 if self.journal(s, low) else 0
        points += 30 if "," in s and _LISTED.search(s) and self.found["authors"].search(s) else 0
        points += 15 if n < 180 and sum(map(s.count, PUNCTUATION)) / max(1, len(s)) > 0.12 else 0
        return min(points, 100) / 100.0


class Headings:
    """The heading predicates for texts at hand, in one line."""

    def __init__(self) -> None:
        self.strict, self.loose = re.compile(rf"(?i)\s*({REFERENCE_HEADINGS})\s*"), re.compile(rf"(?i)\s*({REFERENCE_HEADINGS})\b")
        self.numbered, self.names = re.compile(NUMBERED_HEADING.replace("(?U)", "")), frozenset(SECTION_HEADINGS)
        self.first = frozenset(c for h in REFERENCE_HEADINGS.split("|") for c in (h[0], h[0].upper()))
        self.most_words = max(len(h.split()) for h in SECTION_HEADINGS)

    def reference(self, s: str) -> bool:
        head = s[:80]
        if head.lstrip()[:1] not in self.first:
            return False
        return bool(self.strict.fullmatch(head) or self.loose.match(head) and len(s.split()) <= 6)

    def section(self, s: str, words: int) -> bool:
        """``words`` is the text's word count."""
        if not s:
            return False
        if words <= self.most_words and s.lower().strip(" :.-") in self.names or s[0].isdigit() and self.numbered.match(s):
            return True
        if len(s) > 100 or words > 10 or s[-1] == ".":
            return False
        letters = 0
        for c in s:
            if "A" <= c <= "Z":
                return True
            letters += "a" <= c <= "z"
            if letters == 10:
                return False
        return False


def is_reference_like(c: Column | str, threshold: float = THRESHOLD) -> Column:
    return reference_score(c) >= threshold


def is_reference_heading(c: Column | str) -> Column:
    """A bibliography heading: the keyword alone, or first of at most six words."""

    def holds(s: Column) -> Column:
        head = F.substring(s, 1, 80)
        strict = head.rlike(rf"(?iU)^\s*({REFERENCE_HEADINGS})\s*$")
        loose = head.rlike(rf"(?iU)^\s*({REFERENCE_HEADINGS})\b") & (F.size(words(s)) <= 6)
        return (F.length(s) > 0) & (strict | loose)

    return let(clean_passage(c), holds)


def is_section_heading(c: Column | str) -> Column:
    """A common heading, a numbered one, or a short title-like line without a final period."""

    def holds(s: Column) -> Column:
        letters = F.regexp_replace(s, "[^A-Za-z]", "")
        bare = F.btrim(F.lower(s), F.lit(" :.-"))
        title = (F.length(s) <= 100) & ~s.endswith(".") & (count_words(s) <= 10) & F.substring(letters, 1, 10).rlike("[A-Z]")
        return (F.length(s) > 0) & (bare.isin(*SECTION_HEADINGS) | s.rlike(NUMBERED_HEADING) | title)

    return let(clean_passage(c), holds)


def keep_passages(df, c: str = "text", threshold: float = THRESHOLD):
    """Rows whose text does not look like a bibliography."""
    return df.where(~is_reference_like(col(c), threshold))
