import hashlib
import re

from sparquill.llm import decontam as D
from tests.llm.helpers import docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items):
    wins = {}
    for i, t in items:
        w = words(t)
        if i is not None:
            for k in range(max(1, len(w) - 7) if w else 0):
                wins.setdefault(tuple(w[k : k + 8]), set()).add(i)
    out = []
    for d, t in rows:
        w = words(t)
        hit, own = set(), set()
        for win, ids in wins.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    own |= ids
        out.append((d, len(w), len(hit), sorted(own)))
    return sorted(out, key=str)


ROWS = [(1, "The quick brown fox jumps over the lazy dog and runs away. Short item here"), (2, None), (3, ""), (4, "x " * 3000 + "short ITEM"), (5, "É é über 12 a b c d e f g h i j"), (5, "É é über 12 a b c d e f g h i j"), (6, "a b c d e f g h a b c d e f g h"), (None, "quick brown fox jumps over the lazy dog")]
ITEMS = [(10, "quick brown fox jumps over the lazy dog and"), (2, "Short item"), (3, None), (4, ""), (5, "a b c d e f g h i"), (6, "a b c d e f g h i"), (None, "short item"), (7, "A-B c.d e f g h")]


def frames(spark, items=ITEMS):
    return docs(spark, ROWS), spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, hits int")


def test_against_brute_force(spark):
    found = D.contamination(*frames(spark)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found), key=str) == brute(ROWS, ITEMS)


def test_chunks_of_the_benchmark_agree(spark):
    d, b = frames(spark)
    one, many = (sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), bytes(r.hits)) for r in D.contamination(d, b, chunk_bytes=n).collect()), key=str) for n in (1 << 20, 90))
    assert one == many


def test_empty_tables(spark):
    d, b = frames(spark)
    assert D.contamination(d.limit(0), b).count() == 0
    assert {r.n_hit for r in D.contamination(d, b.limit(0)).collect()} == {0}


def test_digest(spark):
    rows = {r.doc_id: r for r in D.digest(D.contamination(*frames(spark))).collect()}
    assert rows[6].contaminated and rows[6].n_items == 3 and not rows[4].contaminated
    assert rows[6].items_sha256 == hashlib.sha256(b"5,6,7").hexdigest()
    assert rows[3].items_sha256 == hashlib.sha256(b"").hexdigest()


def test_proximity(spark):
    d = docs(spark, [(1, "alpha x beta y y gamma"), (2, "alpha beta"), (3, "alpha " + "z " * 30 + "beta gamma")])
    b = spark.createDataFrame([(9, "gamma alpha beta")], "item_id long, text string")
    index = D.build_index(d)
    assert [(r.doc_id, r.item_id) for r in D.proximity_matches(index, b, reach=6).collect()] == [(1, 9)]
    assert {(r.term, tuple(r.positions)) for r in D.postings_table(index).where("doc_id = 1").collect()} == {("alpha", (0,)), ("x", (1,)), ("beta", (2,)), ("y", (3, 4)), ("gamma", (5,))}
