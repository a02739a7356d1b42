"""Literal cases whose answers follow from the definitions."""

import pytest
from pyspark.sql import functions as F

from sparquill.functions import citations as C
from sparquill.functions import jsonio as J
from sparquill.functions import reference_score as R
from sparquill.functions import text as X
from sparquill.functions import values as V


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("see doi here", 0.35), ("10.1234/a and 10.1234/b words", 0.60), ("at www.a.example now", 0.20), ("Miller et al found", 0.25), ("in 1999 2001 2003 we", 0.35), ("in 1999 2001 2003 2005 2007 we", 0.50),
        ("[1] [2] [3, 4] xx xx xx xx xx", 0.35), ("[1] [2] [3, 4] " + "xx " * 60, 0.20), ("the Journal of it", 0.15), ("Smith, Jones wrote words", 0.0), ("Smith J, Jones K wrote words", 0.30), ("", 1.0), (None, 1.0),
        ("doi doi www.a.example et al 1999 2001 2003 2005 2007 lancet", 1.0),
    ],
)
def test_reference_score(spark, given, expected):
    assert one(spark, given, R.reference_score("x")) == pytest.approx(expected)


def test_reference_score_cut(spark):
    # doi .35 + years .20 + short with years .15 = .70; with a journal .85
    assert not one(spark, "doi 1999 2000 2001 words", R.is_reference_like("x"))
    assert one(spark, "doi 1999 2000 2001 lancet", R.is_reference_like("x"))


@pytest.mark.parametrize(("given", "expected"), [("References", True), ("  bibliography ", True), ("References are listed below.", True), ("references to many other things in here", False), ("reference", False), ("", False)])
def test_reference_heading(spark, given, expected):
    assert one(spark, given, R.is_reference_heading("x")) is expected


@pytest.mark.parametrize(("given", "expected"), [("Methods:", True), ("2.3 Treatment of adults", True), ("Is it safe?", True), ("It is safe.", False), ("no capital here", False), ("", False), ("Follow-up", True)])
def test_section_heading(spark, given, expected):
    assert one(spark, given, R.is_section_heading("x")) is expected


def test_words_and_space(spark):
    assert one(spark, "don't e-mail élan -x a1", X.count_words("x")) == 4  # no boundary between the accented letter and the rest
    assert one(spark, " a  b\r\n c ", X.norm_ws("x")) == "a b c"
    assert one(spark, "a \n\n b\tc\r", X.clean_text("x")) == "a\nb c"
    assert one(spark, "treat-\nment\n\n\nnew\nline", X.normalize_page("x")) == "treatment\n\nnew line"


def test_units_and_sentences(spark):
    assert one(spark, "A b. C d! 1. Introduction", X.units("x")) == ["A b.", "C d!", "1.", "Introduction"]
    assert one(spark, "一。二。 三", X.units("x")) == ["一。二。", "三"]
    assert one(spark, None, X.sentences("x")) == []
    assert one(spark, "One two. Three four five.", X.tail_overlap("x", 1, 2)) == "four five."


def test_cuts(spark):
    assert one(spark, "abc def", X.truncate("x", 4)) == "abc ...[truncated]"
    assert one(spark, "abc def", X.truncate("x", 0)) == "abc def"
    assert one(spark, "abc defgh", X.cut_at_word("x", 6)) == "abc"


def test_lists(spark):
    assert one(spark, ["BP", " ", "bp", "x"], X.distinct_ignoring_case(X.clean_list("x")), "array<string>") == ["BP", "x"]
    assert one(spark, ["a", " ", "b", "c"], X.compact_list("x", 3), "array<string>") == "a; b"
    assert one(spark, None, X.compact_list("x"), "array<string>") == ""


def test_citations(spark):
    assert one(spark, "x [2][2] y [9][1]", C.clamp(C.marks("x"), 5)) == [2, 1]
    assert one(spark, "a. [1]\nb! [2] c", C.cited_sentences("x")) == ["a. [1]", "b! [2]"]
    assert one(spark, "It is so. [1][2] ", C.without_marks("x")) == "It is so."
    assert one(spark, "s12", C.sentence_number("x", F.lit(7))) == 12
    assert one(spark, "none", C.sentence_number("x", F.lit(7))) == 7


@pytest.mark.parametrize(("given", "expected"), [('{"a":1}', '{"a":1}'), ('ok {"a":1} end', '{"a":1}'), ("[1,2]", None), ("no", None), ("", None), (None, None), ('{"a":', None)])
def test_json_object(spark, given, expected):
    assert one(spark, given, J.json_object("x")) == expected


def test_ids(spark):
    assert one(spark, "/a/job_000100_000200.jsonl", V.range_of_file("x")) == (100, 200)
    assert one(spark, "job.jsonl", V.range_of_file("x")["start"]) is None
    assert one(spark, "passage-7", V.number_after("x", "passage")) == 7
    assert one(spark, "passage-x", V.number_after("x", "passage")) is None
    assert one(spark, "g_1_p00002", V.group_of_passage(F.lit(""), "x")) == "g_1"
    assert one(spark, "g_1_p00002", V.document_of_passage("x")) == "g"
    assert one(spark, [0.0, 0.0], V.unit("x"), "array<double>") == [0.0, 0.0]


LINES = [
    "", "References", "references are listed below", "Bibliography of all the works that we have cited in here", "1.2 Treatment of adults", "12", "Key Recommendations:", " scope ", "What now?", "A line that ends.", "a b c d e f g h i j K",
    "Smith J, Jones K, Miller AB. et al. Journal of Care 2001; 2002; 2003; doi 10.1234/x https://a.b/c [1] [2, 3] [4-6]", "see www.x.org 1999 2010 2015 2016 2017", "étude clinique (a), (b); [c]: d.", "Ann Intern Med 10.1000/182 doi doi 2020", "x " * 200 + "Lancet",
]


def test_scores_and_headings_agree_in_both_forms(spark):
    from sparquill.functions import reference_score as R

    score, headings = R.Bibliography(), R.Headings()
    rows = spark.createDataFrame(list(enumerate(LINES)), "k int, x string").select("k", R.reference_score("x").alias("s"), R.is_reference_heading("x").alias("r"), R.is_section_heading("x").alias("h")).collect()
    for r in rows:
        line = " ".join(LINES[r.k].split())
        assert (r.s, r.r, r.h) == (score.score(line), headings.reference(line), headings.section(line, score.words(line)))


def test_words_and_journals_equal_their_patterns():
    import random
    import re

    from sparquill.functions import reference_score as R

    score, dice = R.Bibliography(), random.Random(5)
    parts = [*"aZ09é中ſKİı_'-.,;( )", " ", " ", "j.", "j.x", "Ann", "med", "co-op", "intensive care", "clİn", "ſurg", "medicines"]
    lines = ["".join(dice.choice(parts) for _ in range(dice.randint(0, 12))) for _ in range(4000)]
    own = [len(re.findall(R.WORD_PATTERN, x)) for x in lines]
    assert [score.words(x) for x in lines] == own == score.words_each(lines)
    assert [score.journal(x, x.lower()) for x in lines] == [bool(re.search(R.JOURNAL, x)) for x in lines]
    assert score.words_each([]) == []


def test_slow_patterns_run_only_where_they_can_match():
    from sparquill.functions import reference_score as R

    score = R.Bibliography()
    for name in ("journal", "authors", "word"):
        del score.found[name]  # a use of it raises
    assert score.score("plain words, of a text without any of them; twelve in all, here.") == 0.0


def test_truncation_reads_a_beginning_and_equals_the_whole(spark):
    texts = [None, "", " \u00a0\n", "a b", "x " * 60, " " * 500 + "late", "a" + " " * 300 + "b" * 30, ("ab  " * 9 + " " * 90) * 3, "\U0001f600 " * 99, "abcdefghi" + " " * 200 + "j", "abcdefghij" + " " * 200, "\u2003" * 200 + "é"]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, x string")
    got = rows.select("k", X.truncate("x", 10).alias("t"), X.has_text("x").alias("h")).collect()
    for r in got:
        line = " ".join((texts[r.k] or "").split())
        assert (r.t, r.h) == (line[:10].rstrip() + X.TRUNCATED if len(line) > 10 else line, line != "")


def test_request_texts_are_not_copied_for_other_fields(spark, tmp_path):
    from sparquill.plans import registry

    spark.createDataFrame([(1, "x")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = registry.queries()["request_lines"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("to_variant_object") <= 4  # one for the five fields of a passage wherever the prompt is used


def test_units_agree_in_both_forms(spark):
    from sparquill.operators.chunking import units_of

    for page in (None, "", " a.  b!\tc? d", "one\r\ntwo \n\n three.\n four\x0b.  \x0b\n\x0bfive", "hy-\nphen. 。 x。y。 z"):
        assert units_of(page) == [" ".join(u.split()) for u in one(spark, page, X.units("x"))]


def test_one_row_group_is_spread(spark, tmp_path, monkeypatch):
    from sparquill import runtime

    rows = spark.range(0, 4000, 1, 1).withColumn("t", F.repeat(F.col("id").cast("string"), 40))
    rows.write.parquet(f"{tmp_path}/one.parquet")
    rows.repartition(9).write.parquet(f"{tmp_path}/many.parquet")
    assert runtime.read(spark, str(tmp_path), "one").rdd.getNumPartitions() == 1  # too small to matter
    monkeypatch.setattr(runtime, "SMALL_BYTES", 0)
    whole = runtime.read(spark, str(tmp_path), "one")
    assert whole.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and whole.count() == 4000
    many = runtime.read(spark, str(tmp_path), "many")
    assert "Exchange" not in many._jdf.queryExecution().executedPlan().toString()
