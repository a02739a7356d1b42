"""Personal data in whole texts: spans of the plain patterns, long unbroken texts, the query's columns."""

import hashlib
import random
import re
import time

import pytest

from sparquill.llm import pii
from tests.conftest import SMALL
from tests.llm.helpers import docs, documents

PLAIN = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain(text):
    """Spans by the patterns as they are written, checked one by one."""
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
            ok = (
                True,
                kind == 1 and all(int(x) <= 255 for x in m.group().split(".")),
                16 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0,
                8 <= len(digits) <= 15,
            )[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


@pytest.mark.parametrize("alphabet", ["a@.-%b", "0123.", "1234 -5", "+(1) .-2", "a@.1+ -0"])
def test_spans_equal_the_plain_patterns(alphabet):
    r = random.Random(7)
    for _ in range(3000):
        text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 60)))
        assert sorted(pii.base_spans(text)[0]) == plain(text)


@pytest.mark.parametrize("text", ["a" * 2_000_000 + "@", "7" * 2_000_000, "a1@" * 80_000, "1." * 150_000, "a@b.c%" * 30_000, ("x" * 120 + "5") * 15_000, "+1(" * 80_000], ids=["letters", "digits", "marks", "dots", "emails", "sparse", "plus"])
def test_long_unbroken_texts(text):
    field, began = pii.trained(), time.time()
    base, added = pii.find([text], field)[0]
    assert time.time() - began < 60 and all(0 <= a < b <= len(text) for _, a, b in base + added)


def test_pieces_do_not_change_the_chain(monkeypatch):
    field = pii.trained()
    text = " ".join(t for t, _ in pii.training_rows(40, 5)) + " ² x1 ٣ " + "1 a@ " * 50
    whole = pii.find([text], field)
    for piece in (1, 2, 3, 7):
        monkeypatch.setattr(pii, "PIECE", piece)
        assert pii.find([text], field) == whole


def test_query_columns(spark):
    folder = SMALL.replace("sf0.001", "sf0.01")
    texts = {r.doc_id: r.text for r in documents(spark, folder).collect()}
    rows = pii.op7_personal_data(spark, folder).collect()
    assert len(rows) == len(texts)
    field, name = pii.trained(), dict(enumerate(pii.KINDS))
    for r in rows:
        base = plain(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for k, _, _ in base) for n in range(4)]
        joined = lambda spans: ",".join(f"{name[k]}:{a}:{b}" for k, a, b in sorted(spans))
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest() == pii.digest(base)
        assert r.spans == joined(base + pii.find([texts[r.doc_id]], field)[0][1])


def test_redaction_edges(spark):
    rows = [(1, None), (2, ""), (3, "a@b.c"), (3, "a@b.c"), (None, "+1 234 567 8901"), (4, "word " * 20_000)]
    out = pii.redacted(docs(spark, rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted([(1, None), (2, ""), (3, "<email>"), (3, "<email>"), (None, "<phone>"), (4, "word " * 20_000)], key=str)
    assert pii.redacted(docs(spark, [])).count() == 0
