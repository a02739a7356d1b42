"""Queries over model output and claims: responses, citations, validation, facts, support rates, requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.functions import citations as C
from sparquill.functions import values as N
from sparquill.operators import evaluation as E
from sparquill.operators import tasks as K
from sparquill.operators import validation as V
from sparquill.plans.passages import derived
from sparquill.runtime import read

#: Whole assistant turns as answers of three sentences, a third each, with citations in many forms; t1 and t2 hold the whole turn too; no quotes, backslashes or line ends.
ANSWERED = """
SELECT conv_id * 50 + turn AS idx, concat(p1, '. [1] ', p2, '! [2][3] ', p3) AS answer,
  concat(p1, CASE (conv_id + turn) % 5 WHEN 0 THEN '. [1]' WHEN 1 THEN '. [2][9]' WHEN 2 THEN '. [7]' WHEN 3 THEN '.' ELSE '. [3][3][1][2]' END) AS t1,
  concat('B ', p23, CASE (conv_id + 2 * turn) % 4 WHEN 0 THEN '. [2]' WHEN 1 THEN '' WHEN 2 THEN ' [0] x [4].' ELSE '. [1] [2]' END) AS t2,
  CASE WHEN conv_id % 3 = 0 THEN '' ELSE concat(p3, '. [5]') END AS t3, 1 + turn % 6 AS c1, conv_id % 7 AS c2, CASE WHEN conv_id % 2 = 0 THEN 'benefit_or_effectiveness' WHEN conv_id % 3 = 0 THEN 'unknown' ELSE '' END AS r1
FROM (SELECT conv_id, turn, concat('A ', substr(t, 1, n)) AS p1, concat('B ', substr(t, n + 1, n)) AS p2, concat('C ', substr(t, 2 * n + 1)) AS p3, substr(t, n + 1) AS p23
  FROM (SELECT *, CAST(floor(length(t) / 3) AS INT) AS n FROM (SELECT conv_id, turn, translate(text, concat(chr(34), chr(92), chr(10), chr(9), chr(13), '.!?[]{}'), '            ') AS t FROM conversations WHERE role = 'assistant') x))
"""
#: The same as result lines of a batch: clean, wrapped, in parts, broken, with bad ids.
LINES = f"""
SELECT idx, CASE WHEN idx % 7 = 0 THEN '{{broken' WHEN idx % 7 = 1 THEN concat('{{"custom_id":"', cid, '","response":{{"status_code":200,"body":{{"output_text":"Here: ', e, ' done"}}}}}}')
  WHEN idx % 7 = 2 THEN concat('{{"custom_id":"', cid, '","response":{{"status_code":200,"body":{{"output":[{{"type":"message","content":[{{"type":"output_text","text":"', e, '"}}]}}]}}}}}}')
  WHEN idx % 7 = 3 THEN concat('{{"custom_id":"', cid, '","response":{{"status_code":200,"body":{{"output_text":"no object here"}}}}}}') WHEN idx % 7 = 4 THEN concat('{{"custom_id":"', cid, '","response":null}}')
  ELSE concat('{{"custom_id":"', cid, '","response":{{"status_code":200,"body":{{"output_text":"', e, '"}}}}}}') END AS line
FROM (SELECT idx, CASE WHEN idx % 11 = 3 THEN 'answer-x' ELSE concat('answer-', CAST(idx AS VARCHAR(20))) END AS cid,
  replace(concat('{{"answer_text":"', answer, '","answer_sentences":[{{"text":"', t1, '","citations":[', CAST(c1 AS VARCHAR(9)), '],"role":"', r1, '"}},{{"text":"', t2, '","citations":[', CAST(c2 AS VARCHAR(9)), '],"role":""}}],"evidence_gaps":[]}}'), chr(34), concat(chr(92), chr(34))) AS e
  FROM ({ANSWERED}))
"""


def parsed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = derived(spark, sf_dir, LINES, "conversations")
    rows = K.responses(lines.select("line"), K.ANSWER)
    return rows.groupBy(F.coalesce("error", F.lit("ok")).alias("state")).agg(F.count("*").alias("n"), F.sum(F.length("payload.answer_text")).alias("chars"), F.sum(F.size("payload.answer_sentences")).alias("sentences"))


PARSED = f"""
WITH l AS (SELECT a.idx, CASE WHEN a.idx % 7 = 0 THEN 'line is not JSON' WHEN a.idx % 11 = 3 THEN 'bad custom_id' WHEN a.idx % 7 = 4 THEN 'empty output' WHEN a.idx % 7 = 3 THEN 'no JSON object' ELSE 'ok' END AS state, a.idx % 7 IN (1, 2, 5, 6) AS has, a.answer FROM ({ANSWERED}) a)
SELECT state, count(*) AS n, sum(CASE WHEN has THEN length(answer) END)::BIGINT AS chars, CASE WHEN sum(has::INT) > 0 THEN sum(CASE WHEN has THEN 2 ELSE 0 END) END::BIGINT AS sentences FROM l GROUP BY state
"""


def joined_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses joined to their rows, some of which are missing, and the failed ones with their reason."""
    source = derived(spark, sf_dir, ANSWERED, "conversations").where("idx % 13 <> 5").select(F.col("idx").alias("row_idx"), "answer")
    ok, failed = K.joined(K.responses(derived(spark, sf_dir, LINES, "conversations").select("line"), K.ANSWER), source)
    rows = ok.select("row_idx", F.lit("ok").alias("state"), F.md5("source.answer").alias("answer"))
    return rows.unionByName(failed.select("row_idx", F.col("error").alias("state"), F.lit(None).cast("string").alias("answer")))


JOINED = f"""
WITH l AS (SELECT a.idx, CASE WHEN a.idx % 7 = 0 THEN 'line is not JSON' WHEN a.idx % 11 = 3 THEN 'bad custom_id' WHEN a.idx % 7 = 4 THEN 'empty output' WHEN a.idx % 7 = 3 THEN 'no JSON object' WHEN a.idx % 13 = 5 THEN 'row out of range' ELSE 'ok' END AS state, a.answer FROM ({ANSWERED}) a)
SELECT CASE WHEN state NOT IN ('line is not JSON', 'bad custom_id') THEN idx END AS row_idx, state, CASE WHEN state = 'ok' THEN md5(answer) END AS answer FROM l
"""
#: Model output as strings: clean, wrapped, broken, arrays.
RAW = """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN concat('Sure: ', props, ' bye') WHEN 2 THEN concat('[', props, ']') WHEN 3 THEN '{"a": ' WHEN 4 THEN '' ELSE concat('text ', CAST(event_id AS VARCHAR(20))) END AS raw, props FROM events
"""


def repaired_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparquill.functions.jsonio import json_object

    return derived(spark, sf_dir, RAW, "events").select("event_id", json_object("raw").alias("object"))


REPAIRED = f"SELECT event_id, CASE WHEN event_id % 6 IN (0, 1, 2) THEN trim(props) END AS object FROM ({RAW})"


def citation_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = derived(spark, sf_dir, ANSWERED, "conversations")
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return d.select("idx", text(C.marks("t2")).alias("marks"), text(C.citation_ids("t1")).alias("ids"), text(C.clamp(C.marks("t1"), 5)).alias("clamped"), C.without_marks("t1").alias("bare"), F.array_join(C.cited_sentences("answer"), "|").alias("pieces"))


_MARKS = r"list_transform(regexp_extract_all({0}, '\[(\d+)\]', 1), lambda x: x::INT)"
_DISTINCT = "list_filter({0}, lambda x, i: list_position({0}, x) = i)"
_WS = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"
CITATION_MARKS = rf"""
WITH d AS (SELECT *, {_MARKS.format("t1")} AS m1, {_MARKS.format("t2")} AS m2 FROM ({ANSWERED})), f AS (SELECT *, list_filter(m1, lambda x: x > 0) AS p1, list_filter(m1, lambda x: x BETWEEN 1 AND 5) AS q1 FROM d)
SELECT idx, array_to_string(m2, ',') AS marks, array_to_string({_DISTINCT.format("p1")}, ',') AS ids, array_to_string({_DISTINCT.format("q1")}[1:3], ',') AS clamped, trim(regexp_replace({_WS.format("t1")}, '\s*(?:\[\d+\])+\s*$', '')) AS bare,
  regexp_replace(split_part({_WS.format("answer")}, ' B ', 1), '^\s+|\s+$', '', 'g') || '|B ' || trim(split_part(split_part({_WS.format("answer")}, ' B ', 2), ' C ', 1)) AS pieces FROM f
"""


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = derived(spark, sf_dir, ANSWERED, "conversations")
    return d.withColumn("sentences", F.array(F.struct(F.col("t1").alias("text"), F.array(F.col("c1").cast("int")).alias("citations"), F.col("r1").alias("role")), F.struct(F.col("t2").alias("text"), F.array(F.col("c2").cast("int")).alias("citations"), F.lit("").alias("role"))))


def valid_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = F.array().cast("array<struct<missing_issue:string,reason:string>>")
    ok = _answers(spark, sf_dir).select(F.col("idx").alias("row_idx"), F.struct(F.col("answer").alias("answer_text"), F.col("sentences").alias("answer_sentences"), gaps.alias("evidence_gaps")).alias("payload"), F.struct(F.lit(" ").alias("question_id")).alias("source"))
    rows = V.valid_answers(ok, F.lit(5))
    shown = F.array_join(F.transform("answer_sentences", lambda s: F.concat_ws("/", s["sentence_id"], F.array_join(F.transform(s["citations"], lambda x: x.cast("string")), "."), s["role"])), ";")
    return rows.select("row_idx", "question_id", F.md5("answer_text").alias("answer_text"), shown.alias("sentences"), "error")


_CLAMP = "list_filter(list_filter({0}, lambda x: x BETWEEN 1 AND 5), lambda x, i: list_position(list_filter({0}, lambda y: y BETWEEN 1 AND 5), x) = i)[1:3]"
_ROLES = ", ".join(f"'{r}'" for r in V.ANSWER_ROLES)
VALID_ANSWERS = rf"""
WITH d AS (SELECT *, {_MARKS.format("t1")} AS m1, {_MARKS.format("t2")} AS m2 FROM ({ANSWERED})
), k AS (
  SELECT *, CASE WHEN len({_CLAMP.format("m1")}) > 0 THEN {_CLAMP.format("m1")} ELSE list_filter([c1::INT], lambda x: x BETWEEN 1 AND 5) END AS k1, CASE WHEN len({_CLAMP.format("m2")}) > 0 THEN {_CLAMP.format("m2")} ELSE list_filter([c2::INT], lambda x: x BETWEEN 1 AND 5) END AS k2 FROM d
)
SELECT idx AS row_idx, format('qrow_{{:06d}}', idx) AS question_id, md5({_WS.format("answer")}) AS answer_text,
  CASE WHEN len(k1) + len(k2) > 0 THEN array_to_string(list_filter([
    CASE WHEN len(k1) > 0 THEN 's1/' || array_to_string(k1, '.') || '/' || CASE WHEN r1 IN ({_ROLES}) THEN r1 ELSE 'direct_answer' END END,
    CASE WHEN len(k2) > 0 THEN CASE WHEN len(k1) > 0 THEN 's2/' ELSE 's1/' END || array_to_string(k2, '.') || '/evidence_limitation' END], lambda x: x IS NOT NULL), ';')
  ELSE 's1/1/direct_answer;s2/2.3/evidence_limitation' END AS sentences,
  CASE WHEN len(k1) > 0 AND len(m1) = 0 OR len(k2) > 0 AND len(m2) = 0 THEN 'sentence without visible citation' END AS error
FROM k
"""


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _answers(spark, sf_dir)
    s = F.transform("sentences", lambda x, i: F.struct(F.concat(F.lit("s"), (F.lit(2) - i).cast("string")).alias("sentence_id"), x["text"].alias("text"), x["citations"].alias("citations"), x["role"].alias("role")))
    d = d.withColumn("cited", V.sentences_for_claims("answer", s))
    claims = F.array(F.struct(F.lit(1).alias("sentence_id"), F.array(F.lit("one"), F.lit(" "), F.lit("two")).alias("claims")), F.struct(F.lit(2).alias("sentence_id"), F.array(F.lit("three")).alias("claims")))
    passages = F.array(*(F.struct(F.lit(n).alias("pid"), F.lit(f"text {n}").alias("text"), F.lit(f"p{n}").alias("passage_id"), F.lit("g").alias("guideline_id"), F.lit("m").alias("main_topic"), F.lit("s").alias("section")) for n in (1, 2, 4)))
    return d.withColumn("atomic_facts_flat", V.atomic_facts("cited", claims, passages)).withColumn("passages", passages)


def atomic_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _facts(spark, sf_dir).select("idx", F.explode("atomic_facts_flat").alias("f"))
    num = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ".")
    return rows.select("idx", "f.atomic_fact_id", "f.fact", F.md5("f.source_sentence_text").alias("sentence"), num(F.col("f.citation_ids")).alias("citations"), num(F.transform("f.cited_passages", lambda p: p["pid"])).alias("passages"))


_POS = "list_filter(list_filter({0}, lambda x: x > 0), lambda x, i: list_position(list_filter({0}, lambda y: y > 0), x) = i)[1:3]"
ATOMIC_FACTS = rf"""
WITH d AS (SELECT *, {_MARKS.format("t1")} AS m1, {_MARKS.format("t2")} AS m2 FROM ({ANSWERED})
), k AS (
  SELECT *, CASE WHEN len({_POS.format("m1")}) > 0 THEN {_POS.format("m1")} ELSE list_filter([c1::INT], lambda x: x > 0) END AS k1, CASE WHEN len({_POS.format("m2")}) > 0 THEN {_POS.format("m2")} ELSE list_filter([c2::INT], lambda x: x > 0) END AS k2 FROM d
), s AS (
  SELECT idx, 1 AS sid, CASE WHEN len(k2) > 0 THEN t2 ELSE t1 END AS t, CASE WHEN len(k2) > 0 THEN k2 ELSE k1 END AS c FROM k WHERE len(k1) + len(k2) > 0
  UNION ALL SELECT idx, 2, t1, k1 FROM k WHERE len(k1) > 0 AND len(k2) > 0
), f AS (SELECT * FROM s JOIN (VALUES (1, 1, 'one'), (1, 2, 'two'), (2, 1, 'three')) v(sid, n, fact) USING (sid))
SELECT idx, 's' || sid || '_a' || n AS atomic_fact_id, fact, md5(trim(regexp_replace({_WS.format("t")}, '\s*(?:\[\d+\])+\s*$', ''))) AS sentence, array_to_string(c, '.') AS citations, array_to_string(list_filter(c, lambda x: x IN (1, 2, 4)), '.') AS passages FROM f
"""


def fact_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _facts(spark, sf_dir).select(F.col("idx").alias("item_id"), F.lit("other").alias("question_type"), "atomic_facts_flat", "passages")
    return E.claims(items).select("item_id", "atomic_fact_id", "num_cited_passages", "filter_reason", F.md5("premise").alias("premise"))


_PREMISE = "'Passage ' || {0} || chr(10) || 'passage_id: p' || {0} || chr(10) || 'guideline_id: g' || chr(10) || 'main_topic: m' || chr(10) || 'section: s' || chr(10) || 'text ' || {0}"
FACT_EVIDENCE = f"""
SELECT idx AS item_id, atomic_fact_id, len(l)::INT AS num_cited_passages, CASE WHEN len(l) > 0 THEN 'kept' ELSE 'no_cited_passage' END AS filter_reason,
  CASE WHEN len(l) > 0 THEN md5(array_to_string(list_transform(l, lambda p: {_PREMISE.format("p")}), chr(10) || chr(10))) END AS premise
FROM (SELECT *, CASE WHEN passages = '' THEN [] ELSE string_split(passages, '.') END AS l FROM ({ATOMIC_FACTS}))
"""
#: Four documents make an item; every sixth item has no claims, its documents' claims go to the item before.
_ITEM = "CAST(floor(doc_id / 4) AS BIGINT)"
ITEMS = f"SELECT item_id, CASE WHEN item_id % 4 = 0 THEN 'eligibility' WHEN item_id % 4 = 1 THEN NULL ELSE 'other' END AS question_type FROM (SELECT DISTINCT {_ITEM} AS item_id FROM documents) i"
#: Claims of the items: verdicts for labelled documents, others skipped.
CLAIMS = f"""
SELECT item_id, CASE WHEN item_id % 4 = 0 THEN 'eligibility' WHEN item_id % 4 = 1 THEN NULL ELSE 'other' END AS question_type, d.doc_id AS ordinal, concat('s', CAST(d.doc_id AS VARCHAR(20)), '_a1') AS atomic_fact_id,
  CASE WHEN d.doc_id % 5 = 0 THEN NULL WHEN d.doc_id % 5 < 3 THEN 'direct_answer' ELSE 'risk_or_safety' END AS source_sentence_role, l.doc_id IS NOT NULL AS filter_keep,
  CASE WHEN l.doc_id IS NOT NULL THEN 'kept' WHEN d.doc_id % 2 = 0 THEN 'empty_claim' ELSE 'no_cited_passage' END AS filter_reason, l.quality AS joint_entailment
FROM (SELECT doc_id, {_ITEM} - CASE WHEN {_ITEM} % 6 = 5 THEN 1 ELSE 0 END AS item_id FROM documents) d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, CLAIMS, "documents", "labels")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.per_item(derived(spark, sf_dir, ITEMS, "documents"), _claims(spark, sf_dir))


def item_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir).drop("question_type").withColumn("support_rate", F.round("support_rate", 9))


_COUNTS = "count(atomic_fact_id) AS num_raw, count(*) FILTER (WHERE filter_keep) AS num_evaluated, count(*) FILTER (WHERE filter_keep AND joint_entailment = 1) AS num_supported, count(*) FILTER (WHERE filter_keep AND joint_entailment = 0) AS num_unsupported, count(*) FILTER (WHERE NOT filter_keep) AS num_skipped"
_PER_ITEM = f"""
SELECT i.item_id, coalesce(num_raw, 0) AS num_raw, coalesce(num_evaluated, 0) AS num_evaluated, coalesce(num_supported, 0) AS num_supported, coalesce(num_unsupported, 0) AS num_unsupported, coalesce(num_skipped, 0) AS num_skipped, num_supported / nullif(num_evaluated, 0) AS rate
FROM ({ITEMS}) i LEFT JOIN (SELECT item_id, {_COUNTS} FROM ({CLAIMS}) GROUP BY item_id) c ON i.item_id = c.item_id
"""
ITEM_RATES = f"SELECT * EXCLUDE (rate), round(rate, 9) AS support_rate FROM ({_PER_ITEM})"


def data_set_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = E.summary(_items(spark, sf_dir))
    return s.withColumn("micro_rate", F.round("micro_rate", 9)).withColumn("macro_rate", F.round("macro_rate", 9))


DATA_SET_RATES = f"""
SELECT count(*) AS num_items, sum(num_raw)::BIGINT AS num_claims_raw, sum(num_evaluated)::BIGINT AS num_claims_evaluated, sum(num_supported)::BIGINT AS num_claims_supported, sum(num_unsupported)::BIGINT AS num_claims_unsupported, sum(num_skipped)::BIGINT AS num_claims_skipped,
  round(sum(num_supported) / nullif(sum(num_evaluated), 0), 9) AS micro_rate, round(avg(rate), 9) AS macro_rate, count(*) FILTER (WHERE rate IS NULL) AS num_items_without_evaluated,
  count(*) FILTER (WHERE rate > 0.8) AS num_items_gt_0_8, count(*) FILTER (WHERE rate >= 0.8) AS num_items_ge_0_8, count(*) FILTER (WHERE rate = 1) AS num_items_eq_1 FROM ({_PER_ITEM})
"""


def role_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.by_key(_claims(spark, sf_dir), "source_sentence_role").withColumn("support_rate", F.round("support_rate", 9))


ROLE_RATES = f"SELECT coalesce(source_sentence_role, '') AS source_sentence_role, {_COUNTS}, round(count(*) FILTER (WHERE filter_keep AND joint_entailment = 1) / nullif(count(*) FILTER (WHERE filter_keep), 0), 9) AS support_rate FROM ({CLAIMS}) GROUP BY 1"


def claim_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.rollup(_claims(spark, sf_dir)).drop("level")


CLAIM_ROLLUP = f"""
SELECT item_id, role, qt AS question_type, {_COUNTS} FROM (SELECT *, coalesce(source_sentence_role, '') AS role, coalesce(question_type, '') AS qt FROM ({CLAIMS}))
GROUP BY GROUPING SETS ((item_id, role), (role), (qt), ())
"""


def role_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = E.as_maps(E.by_key(_claims(spark, sf_dir), "source_sentence_role", "item_id"), "source_sentence_role", "item_id")
    shown = lambda m: F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ";")
    return rows.select("item_id", shown("counts_raw").alias("raw"), shown("counts_evaluated").alias("evaluated"), shown("counts_supported").alias("supported"), F.size("support_rates").cast("long").alias("n_rates"))


_ROLE_ITEM = f"SELECT item_id, coalesce(source_sentence_role, '') AS role, {_COUNTS} FROM ({CLAIMS}) GROUP BY ALL"
ROLE_MAPS = f"""
SELECT item_id, coalesce(string_agg(role || '=' || num_raw, ';' ORDER BY role) FILTER (WHERE num_raw > 0), '') AS raw, coalesce(string_agg(role || '=' || num_evaluated, ';' ORDER BY role) FILTER (WHERE num_evaluated > 0), '') AS evaluated,
  coalesce(string_agg(role || '=' || num_supported, ';' ORDER BY role) FILTER (WHERE num_supported > 0), '') AS supported, count(*) FILTER (WHERE num_evaluated > 0) AS n_rates FROM ({_ROLE_ITEM}) GROUP BY item_id
"""


def skip_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.skipped_reasons(_claims(spark, sf_dir))


SKIP_REASONS = f"SELECT filter_reason, count(*) AS n FROM ({CLAIMS}) WHERE NOT filter_keep GROUP BY 1"
#: Model output for questions and annotations as columns.
MODEL_OUTPUT = """
SELECT doc_id, source, CASE doc_id % 8 WHEN 0 THEN 'What does this guideline say?' WHEN 1 THEN '  ' ELSE concat(' How  do I know ', CAST(doc_id AS VARCHAR(20)), '? ') END AS question,
  CASE WHEN doc_id % 3 = 0 THEN 'eligibility' ELSE 'bogus' END AS question_type, CASE WHEN doc_id % 4 = 0 THEN 'patient_self' ELSE '' END AS perspective, CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'alpha' END AS k1, CASE WHEN doc_id % 7 = 0 THEN ' ' ELSE ' beta  x ' END AS k2,
  CASE WHEN doc_id % 6 = 2 THEN '' ELSE 'gamma' END AS a1, doc_id % 4 <> 3 AS usable, CASE WHEN doc_id % 9 = 0 THEN '' ELSE concat('m', CAST(doc_id AS VARCHAR(20))) END AS passage_id FROM documents
"""


def valid_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = derived(spark, sf_dir, MODEL_OUTPUT, "documents")
    q = F.struct("question", "question_type", "perspective", F.array("k1", "k2").alias("patient_keywords"), F.array("a1").alias("retrieval_anchor_terms"))
    ok = d.select(F.col("doc_id").alias("row_idx"), F.struct(F.lit("").alias("pool_id"), F.lit(None).cast("string").alias("guideline_id"), F.array(q).alias("questions"), F.lit("").alias("skip_reason")).alias("payload"), F.struct(F.concat(F.lit("grp"), "doc_id").alias("group_id"), F.col("source").alias("guideline_id")).alias("source"))
    q = F.try_element_at("questions", F.lit(1))
    return V.valid_questions(ok).select(
        "row_idx", "pool_id", "guideline_id", F.size("questions").alias("n"), q["question_id"].alias("question_id"), q["question"].alias("question"), q["question_type"].alias("question_type"), q["perspective"].alias("perspective"),
        F.array_join(q["patient_keywords"], ",").alias("keywords"), F.array_join(q["retrieval_anchor_terms"], ",").alias("anchors"), "skip_reason",
    )


VALID_QUESTIONS = rf"""
WITH d AS (SELECT *, {_WS.format("question")} AS q, list_filter([trim(k1), {_WS.format("k2")}], lambda x: x <> '') AS k FROM ({MODEL_OUTPUT})
), v AS (SELECT *, q <> '' AND NOT contains(lower(q), 'this guideline') AND (a1 <> '' OR len(k) > 0) AS ok FROM d)
SELECT doc_id AS row_idx, 'grp' || doc_id AS pool_id, source AS guideline_id, ok::INT AS n, CASE WHEN ok THEN format('q_{{:06d}}_01', doc_id) END AS question_id, CASE WHEN ok THEN q END AS question,
  CASE WHEN ok THEN CASE WHEN question_type = 'eligibility' THEN question_type ELSE 'other' END END AS question_type, CASE WHEN ok THEN CASE WHEN perspective = 'patient_self' THEN perspective ELSE 'general_health_info_seeker' END END AS perspective,
  CASE WHEN ok THEN array_to_string(k, ',') END AS keywords, CASE WHEN ok THEN CASE WHEN a1 <> '' THEN a1 ELSE array_to_string(k[1:3], ',') END END AS anchors, CASE WHEN ok THEN '' ELSE '{V.NO_QUESTION}' END AS skip_reason FROM v
"""


def valid_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = derived(spark, sf_dir, MODEL_OUTPUT, "documents")
    payload = F.struct("passage_id", "usable", F.lit(" x  y ").alias("discard_reason"), F.lit("mixed").alias("content_type"), F.col("question").alias("main_topic"), F.lit(None).cast("string").alias("semantic_summary"), F.array("k1", "k2", "a1", F.lit("d"), F.lit("e"), F.lit("f")).alias("question_angles"), F.array("k2").alias("patient_language_keywords"))
    source = F.struct(F.concat(F.lit("s"), "doc_id").alias("passage_id"), F.col("source").alias("guideline_id"), F.lit("a.pdf").alias("source_pdf"), F.lit("").alias("section_title"), F.lit(1).alias("page_start"), F.lit(2).alias("page_end"), F.lit(3).alias("word_count"), F.lit(0.5).alias("reference_list_score"), F.lit("t").alias("text"))
    rows = V.valid_seeds(d.select(F.col("doc_id").alias("row_idx"), payload.alias("payload"), source.alias("source")))
    return rows.select("sample_idx", "passage_id", "usable", "discard_reason", "main_topic", "semantic_summary", F.array_join("question_angles", ",").alias("angles"), F.array_join("patient_language_keywords", ",").alias("keywords"), "guideline_id")


VALID_SEEDS = rf"""
SELECT doc_id AS sample_idx, CASE WHEN passage_id <> '' THEN passage_id ELSE 's' || doc_id END AS passage_id, usable, 'x y' AS discard_reason, {_WS.format("question")} AS main_topic, '' AS semantic_summary,
  CASE WHEN usable THEN array_to_string(list_filter([k1, {_WS.format("k2")}, a1, 'd', 'e', 'f'], lambda x: x <> '')[1:4], ',') ELSE '' END AS angles, CASE WHEN usable THEN {_WS.format("k2")} ELSE '' END AS keywords, source AS guideline_id FROM ({MODEL_OUTPUT})
"""


def request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = derived(spark, sf_dir, "SELECT doc_id AS row_idx, substr(text, 1, 200) AS question, CASE WHEN doc_id % 5 = 0 THEN '' ELSE substr(text, 201) END AS t FROM documents", "documents")
    p = F.struct(F.lit("p1").alias("passage_id"), F.lit("g").alias("guideline_id"), F.lit("m").alias("main_topic"), F.lit(" Care  of x ").alias("section"), ((F.col("row_idx") % 5 - 1) / 4).alias("rerank_score"), F.col("t").alias("text"))
    rows = K.requests(d.withColumn("retrieved_passages", F.array(p)), K.ANSWER, K.answer_prompt(max_chars=50), "model-x")
    at = lambda path: F.get_json_object("line", path)
    return rows.select("row_idx", at("$.custom_id").alias("custom_id"), at("$.body.temperature").cast("double").alias("temperature"), at("$.body.text.format.name").alias("schema_name"), F.md5(at("$.body.input[1].content")).alias("prompt"))


REQUEST_LINES = rf"""
WITH d AS (SELECT doc_id AS row_idx, {_WS.format("substr(text, 1, 200)")} AS q, {_WS.format("CASE WHEN doc_id % 5 = 0 THEN '' ELSE substr(text, 201) END")} AS t FROM documents)
SELECT row_idx, 'answer-' || row_idx AS custom_id, 0.2::DOUBLE AS temperature, 'answer' AS schema_name,
  md5('Question: ' || q || chr(10) || chr(10) || 'Passages:' || chr(10) || '[1]' || chr(10) || 'passage_id: p1' || chr(10) || 'guideline_id: g' || chr(10) || 'main_topic: m' || chr(10) || 'section: Care of x' || chr(10) || 'rerank_score: ' || CASE row_idx % 5 WHEN 1 THEN '' WHEN 2 THEN '0.25' WHEN 3 THEN '0.5' ELSE '0.75' END || chr(10) || 'text: ' || CASE WHEN length(t) > 50 THEN rtrim(t[1:50]) || ' ...[truncated]' ELSE t END) AS prompt
FROM d WHERE q <> '' AND t <> ''
"""


_PASSAGES = """
SELECT doc_id AS row_idx, CASE WHEN doc_id % 5 = 0 THEN ' ' ELSE concat('p', CAST(doc_id AS VARCHAR(20))) END AS passage_id, source AS guideline_id, lang AS section_title, 1 AS page_start, 2 AS page_end, CAST(doc_id % 9 AS INT) AS word_count,
  0.5 AS reference_list_score, CASE WHEN doc_id % 7 = 0 THEN '' ELSE text END AS text FROM documents
"""


def seed_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of the annotation task; rows without an id or a text are skipped."""
    d = derived(spark, sf_dir, _PASSAGES, "documents").withColumn("reference_list_score", F.lit("0.5"))
    at = lambda path: F.get_json_object("line", path)
    return K.requests(d, K.SEED, K.seed_prompt(), "m").select("row_idx", at("$.custom_id").alias("custom_id"), F.md5(at("$.body.input[1].content")).alias("prompt"))


SEED_PROMPTS = rf"""
SELECT row_idx, 'passage-' || row_idx AS custom_id, md5('passage_id: ' || passage_id || chr(10) || 'guideline_id: ' || guideline_id || chr(10) || 'section_title: ' || section_title || chr(10) || 'page_start: 1' || chr(10) || 'page_end: 2' || chr(10)
  || 'word_count: ' || word_count || chr(10) || 'reference_list_score: 0.5' || chr(10) || chr(10) || 'Passage text:' || chr(10) || text) AS prompt
FROM ({_PASSAGES}) WHERE passage_id <> ' ' AND {_WS.format("text")} <> ''
"""


def claim_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of the claims task: numbered sentences with what they cite; rows without a cited sentence are skipped."""
    d = _facts(spark, sf_dir).select(F.col("idx").alias("row_idx"), F.concat(F.lit(" q  "), "idx").alias("question"), F.when(F.col("idx") % 4 > 0, F.col("cited")).otherwise(F.slice("cited", 1, 0)).alias("cited"))
    at = lambda path: F.get_json_object("line", path)
    return K.requests(d, K.CLAIMS, K.claims_prompt("cited"), "m").select("row_idx", at("$.body.max_output_tokens").cast("long").alias("most"), F.md5(at("$.body.input[1].content")).alias("prompt"))


CLAIM_PROMPTS = ATOMIC_FACTS[: ATOMIC_FACTS.rindex("), f AS (")] + rf""")
SELECT idx AS row_idx, 1600::BIGINT AS most, md5('Question: q ' || idx || chr(10) || chr(10) || string_agg('SENTENCE ' || sid || chr(10) || 'TEXT: ' || trim(regexp_replace({_WS.format("t")}, '\s*(?:\[\d+\])+\s*$', '')) || chr(10) || 'CITATIONS: [' || array_to_string(c, ', ') || ']', chr(10) || chr(10) ORDER BY sid)) AS prompt
FROM s WHERE idx % 4 > 0 GROUP BY idx
"""


def formatted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time tags, rounded values, compact lists and compact JSON."""
    from sparquill.functions.jsonio import compact
    from sparquill.functions.text import compact_list

    d = read(spark, sf_dir, "events")
    items = F.array(F.concat(F.lit(" "), "event_type", F.lit("  x ")), F.lit(" "), F.col("props"), F.lit("y"))
    return d.select("event_id", N.time_tag(F.col("ts")).alias("tag"), N.rounded(F.col("value") / 7, 3).alias("value"), compact_list(items, 3).alias("items"), compact(F.struct("event_id", "event_type")).alias("object"))


FORMATTED = rf"""
SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS tag, round(value / 7, 3) AS value, {_WS.format("event_type")} || ' x' || CASE WHEN {_WS.format("props")} <> '' THEN '; ' || {_WS.format("props")} ELSE '' END AS items,
  '{{"event_id":' || event_id || ',"event_type":"' || event_type || '"}}' AS object FROM events
"""


def id_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = derived(spark, sf_dir, "SELECT doc_id, doc_id % 3 AS a, doc_id % 5 AS b, doc_id % 7 AS c FROM documents", "documents")
    return d.select("doc_id", F.round(N.jaccard(F.array("a", "b"), F.array("b", "c")), 9).alias("jaccard"), N.jaccard(F.array().cast("array<long>"), F.array("a")).alias("none"), F.round(N.rate(F.col("a"), F.col("b")), 9).alias("rate"))


ID_OVERLAP = """
SELECT doc_id, round(len(list_intersect(list_distinct([a, b]), list_distinct([b, c]))) / len(list_distinct([a, b, c])), 9) AS jaccard, 0.0::DOUBLE AS "none", round(a / nullif(b, 0), 9) AS rate
FROM (SELECT doc_id, doc_id % 3 AS a, doc_id % 5 AS b, doc_id % 7 AS c FROM documents)
"""

#: Passages that hold some of four words; claims of them, an empty one, and a repeated fact id.
CLAIMED = """
SELECT doc_id, concat('alpha', CASE WHEN doc_id % 2 = 0 THEN ' beta' ELSE '' END, CASE WHEN doc_id % 3 = 0 THEN ' gamma' ELSE '' END, CASE WHEN doc_id % 7 = 0 THEN ' delta' ELSE '' END) AS t,
  CASE WHEN doc_id % 5 = 0 THEN ' ' ELSE 'gamma Delta' END AS c2, CASE WHEN doc_id % 11 = 0 THEN 's1_a1' ELSE 's1_a3' END AS id3 FROM documents
"""


def evaluated_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of every item with the verdict on them: each distinct (premise, claim) is asked once, the last verdict of a repeated id counts."""
    from sparquill.operators.models import containment_entailment

    d = derived(spark, sf_dir, CLAIMED, "documents")
    passage = F.struct(F.lit(1).alias("pid"), *(F.lit(v).alias(k) for k, v in (("passage_id", "p"), ("guideline_id", "g"), ("main_topic", "m"), ("section", "s"))), F.col("t").alias("text"))
    fact = lambda i, c: F.struct(i.alias("atomic_fact_id"), c.alias("fact"), F.lit(1).alias("source_sentence_id"), F.lit("direct_answer").alias("source_sentence_role"), F.array(F.lit(1)).alias("citation_ids"), F.array(passage).alias("cited_passages"))
    facts = F.array(fact(F.lit("s1_a1"), F.lit("Alpha beta gamma delta")), fact(F.lit("s1_a2"), F.col("c2")), fact(F.col("id3"), F.lit("alpha")))
    items = d.select(F.col("doc_id").alias("item_id"), F.lit("other").alias("question_type"), facts.alias("atomic_facts_flat"), F.array(passage).alias("passages"))
    rows = E.augmented(items, E.verified(E.claims(items), containment_entailment())).select("item_id", F.explode("evaluated_facts").alias("f"))
    return rows.select("item_id", F.col("f.ordinal").cast("long").alias("ordinal"), "f.atomic_fact_id", "f.claim", "f.evaluation.filter_reason", F.col("f.evaluation.joint_entailment").cast("long").alias("verdict"), F.col("f.evaluation.joint_raw_output").alias("raw_output"))


EVALUATED = f"""
WITH d AS (SELECT doc_id AS item_id, trim(c2) AS c2, id3, (1 + (doc_id % 2 = 0)::INT + (doc_id % 3 = 0)::INT + (doc_id % 7 = 0)::INT >= 3)::BIGINT AS v1, (doc_id % 21 = 0)::BIGINT AS v2 FROM ({CLAIMED})
), f AS (
  SELECT item_id, 0 AS ordinal, 's1_a1' AS atomic_fact_id, 'Alpha beta gamma delta' AS claim, 'kept' AS filter_reason, CASE WHEN id3 = 's1_a1' THEN 1 ELSE v1 END AS verdict FROM d
  UNION ALL SELECT item_id, 1, 's1_a2', c2, CASE WHEN c2 = '' THEN 'empty_claim' ELSE 'kept' END, CASE WHEN c2 <> '' THEN v2 END FROM d
  UNION ALL SELECT item_id, 2, id3, 'alpha', 'kept', 1 FROM d
)
SELECT item_id, ordinal::BIGINT AS ordinal, atomic_fact_id, claim, filter_reason, verdict::BIGINT AS verdict, verdict::VARCHAR AS raw_output FROM f
"""

QUERIES = {
    "seed_prompts": (seed_prompts, SEED_PROMPTS), "claim_prompts": (claim_prompts, CLAIM_PROMPTS), "formatted_values": (formatted_values, FORMATTED), "joined_responses": (joined_responses, JOINED), "evaluated_facts": (evaluated_facts, EVALUATED), "parsed_responses": (parsed_responses, PARSED), "repaired_json": (repaired_json, REPAIRED), "citation_marks": (citation_marks, CITATION_MARKS), "valid_answers": (valid_answers, VALID_ANSWERS), "atomic_facts": (atomic_facts, ATOMIC_FACTS),
    "fact_evidence": (fact_evidence, FACT_EVIDENCE), "item_rates": (item_rates, ITEM_RATES), "data_set_rates": (data_set_rates, DATA_SET_RATES), "role_rates": (role_rates, ROLE_RATES), "claim_rollup": (claim_rollup, CLAIM_ROLLUP), "role_maps": (role_maps, ROLE_MAPS),
    "skip_reasons": (skip_reasons, SKIP_REASONS), "valid_questions": (valid_questions, VALID_QUESTIONS), "valid_seeds": (valid_seeds, VALID_SEEDS), "request_lines": (request_lines, REQUEST_LINES), "id_overlap": (id_overlap, ID_OVERLAP),
}
