"""Queries over embeddings and annotations: pools, index rows, recall, reranking, resume."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.functions import text as X
from sparquill.functions import values as V
from sparquill.operators import pools as P
from sparquill.operators import retrieval as T
from sparquill.operators.models import overlap_score
from sparquill.operators.vectors import search
from sparquill.plans.passages import derived
from sparquill.runtime import read

#: Pool parameters for the fixture's vectors, whose similarities are lower than those of text vectors.
POOL = {"min_passages": 3, "max_passages": 8, "min_similarity": 0.15}
MAX_JACCARD = 0.3
RECALL_K, OUT_K = 10, 3


def _passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(F.col("label").alias("group"), F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


def _pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.pools(P.members(_passages(spark, sf_dir), **POOL))


def _rounded(rows: DataFrame) -> DataFrame:
    return rows.select(
        "group", "anchor", "num_passages", F.round("avg_similarity", 6).alias("avg_similarity"), F.round("min_similarity", 6).alias("min_similarity"), F.array_join(F.transform("passage_ids", lambda x: x.cast("string")), ",").alias("passage_ids")
    )


def topic_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_pools(spark, sf_dir))


_POOLS = f"""
e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
), big AS (SELECT label FROM e GROUP BY label HAVING count(*) >= {POOL["min_passages"]}
), near AS (
  SELECT a.label, a.vec_id AS anchor, b.vec_id AS id, list_dot_product(a.v, b.v) AS score FROM e a JOIN e b USING (label) JOIN big USING (label)
), top AS (
  SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY label, anchor ORDER BY score DESC, id) <= {POOL["max_passages"]}
), mem AS (
  SELECT *, row_number() OVER (PARTITION BY label, anchor ORDER BY score DESC, id) AS rank FROM top WHERE score >= {POOL["min_similarity"]} OR id = anchor
), pool AS (
  SELECT label::VARCHAR AS "group", anchor, count(*) AS num_passages, coalesce(avg(CASE WHEN rank > 1 THEN score END), 1.0) AS avg_s, min(score) AS min_s, list(id ORDER BY rank) AS ids
  FROM mem GROUP BY label, anchor HAVING count(*) >= {POOL["min_passages"]}
)
"""
_POOL_ROW = """SELECT "group", anchor, num_passages, round(avg_s, 6) AS avg_similarity, round(min_s, 6) AS min_similarity, array_to_string(ids, ',') AS passage_ids"""
TOPIC_POOLS = f"WITH {_POOLS} {_POOL_ROW} FROM pool"


def distinct_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(P.without_near_duplicates(_pools(spark, sf_dir), MAX_JACCARD))


#: Goes through the pools of a group in order of priority with the kept id lists at hand; pools of other groups share no ids.
DISTINCT_POOLS = f"""
WITH RECURSIVE {_POOLS}
, o AS (SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY avg_s DESC, num_passages DESC, anchor) AS r FROM pool
), go AS (
  SELECT "group", 0::BIGINT AS r, []::BIGINT[][] AS kept, false AS keep FROM (SELECT DISTINCT "group" FROM pool)
  UNION ALL
  SELECT g."group", o.r, CASE WHEN ok THEN list_append(kept, g.ids) ELSE kept END, ok
  FROM (
    SELECT g."group", g.r, g.kept, o.r AS r2, o.ids, len(list_filter(g.kept, lambda k: len(list_intersect(k, o.ids)) / (len(k) + len(o.ids) - len(list_intersect(k, o.ids))) >= {MAX_JACCARD})) = 0 AS ok
    FROM go g JOIN o ON o."group" = g."group" AND o.r = g.r + 1
  ) g JOIN o ON o."group" = g."group" AND o.r = g.r2
)
{_POOL_ROW} FROM o JOIN go USING ("group", r) WHERE keep
"""


def pool_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = P.statistics(_pools(spark, sf_dir))
    return s.select("num_groups", *(F.round(c, 6).alias(c) for c in s.columns if c != "num_groups"))


POOL_STATISTICS = f"""
WITH {_POOLS} SELECT count(*) AS num_groups, round(coalesce(avg(num_passages), 0), 6) AS mean_size, coalesce(min(num_passages), 0)::DOUBLE AS min_size, coalesce(max(num_passages), 0)::DOUBLE AS max_size,
  round(coalesce(avg(avg_s), 0), 6) AS mean_similarity, round(coalesce(min(avg_s), 0), 6) AS min_similarity, round(coalesce(max(avg_s), 0), 6) AS max_similarity FROM pool
"""


def numbered_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.numbered(_pools(spark, sf_dir).withColumn("avg_similarity", F.round("avg_similarity", 9)))
    return rows.select("group_id", "group", "anchor")


NUMBERED_POOLS = f"""
WITH {_POOLS} SELECT format('grp_{{:06d}}', row_number() OVER (ORDER BY round(avg_s, 9) DESC, num_passages DESC, "group", anchor)) AS group_id, "group", anchor FROM pool
"""
#: Annotated passages of whole texts: ids repeated in pairs of neighbours, empty first occurrences, unusable ones, keywords that differ in case.
SEEDS = """
SELECT doc_id AS row_idx, CASE WHEN doc_id % 11 = 0 THEN '' ELSE concat('g', CAST(doc_id % 40 - doc_id % 2 AS VARCHAR(9)), '_p', CAST(doc_id - doc_id % 2 AS VARCHAR(20))) END AS passage_id, doc_id % 6 <> 0 AS usable,
  CASE WHEN doc_id % 10 = 3 THEN 'reference_like' WHEN doc_id % 10 = 4 THEN NULL ELSE 'mixed' END AS content_type, CASE WHEN doc_id % 9 = 0 THEN '  ' ELSE substr(text, 1, 20) END AS main_topic, substr(text, 21, 60) AS semantic_summary,
  CASE WHEN doc_id % 13 = 5 THEN ' ' ELSE text END AS source_text, substr(text, 1, 5) AS w1, substr(text, 7, 5) AS w2, lower(substr(text, 1, 5)) AS w3, lower(substr(text, 7, 5)) AS w4 FROM documents
"""


def _seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, SEEDS, "documents").withColumn("patient_language_keywords", F.array("w1", "w2", "w3")).withColumn("question_angles", F.array(F.lit(" "), "w4", "w1"))


def usable_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.usable(_seeds(spark, sf_dir)).select("row_idx", F.md5(T.pool_embed_text(True, 200)).alias("embed_text"))


_N = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"
_S = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
USABLE_SEEDS = rf"""
SELECT row_idx, md5('Topic: ' || {_S.format("main_topic")} || chr(10) || 'Summary: ' || {_S.format("semantic_summary")} || chr(10) || 'Question angles: ' || array_to_string(list_filter([{_S.format("w4")}, {_S.format("w1")}], lambda x: x <> ''), '; ')
  || chr(10) || 'Patient keywords: ' || array_to_string(list_filter([{_S.format("w1")}, {_S.format("w2")}, {_S.format("w3")}], lambda x: x <> ''), '; ') || chr(10) || 'Content type: ' || coalesce(content_type, '')
  || CASE WHEN {_S.format("source_text")} <> '' THEN chr(10) || 'Source text: ' || {_S.format("source_text")}[1:200] ELSE '' END) AS embed_text
FROM ({SEEDS}) WHERE usable AND coalesce(content_type, '') NOT IN ('methods_or_search_strategy', 'admin_or_metadata', 'reference_like')
"""


def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.index_rows(_seeds(spark, sf_dir), only_usable=False)
    return rows.select("row_idx", "passage_id", "guideline_id", F.md5("text").alias("text"), F.md5("embedding_text").alias("embedding_text"))


INDEX_ROWS = rf"""
WITH s AS (
  SELECT *, CASE WHEN passage_id <> '' THEN passage_id ELSE format('passage_{{:06d}}', row_idx) END AS pid, list_filter([{_N.format("w1")}, {_N.format("w2")}, {_N.format("w3")}, {_N.format("w4")}, {_N.format("w1")}], lambda x: x <> '') AS k FROM ({SEEDS})
), f AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY pid ORDER BY row_idx) = 1
), kw AS (
  SELECT row_idx, string_agg(w, '; ' ORDER BY i) AS words FROM (
    SELECT row_idx, i, k[i] AS w FROM (SELECT row_idx, k, unnest(range(1, len(k) + 1)) AS i FROM f) QUALIFY row_number() OVER (PARTITION BY row_idx, lower(k[i]) ORDER BY i) = 1)
  GROUP BY row_idx
)
SELECT row_idx, pid AS passage_id, CASE WHEN contains(pid, '_') THEN split_part(pid, '_', 1) ELSE '' END AS guideline_id, md5({_N.format("source_text")}) AS text,
  md5(array_to_string(list_filter([CASE WHEN {_N.format("main_topic")} <> '' THEN 'Topic: ' || {_N.format("main_topic")} END, CASE WHEN {_N.format("semantic_summary")} <> '' THEN 'Summary: ' || {_N.format("semantic_summary")} END,
    CASE WHEN words <> '' THEN 'Patient keywords: ' || words END, 'Guideline passage: ' || {_N.format("source_text")}], lambda x: x IS NOT NULL), chr(10))) AS embedding_text
FROM f LEFT JOIN kw USING (row_idx) WHERE {_N.format("source_text")} <> ''
"""


def query_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("question"))
    b = b.withColumn("retrieval_anchor_terms", F.slice(X.words("question"), 1, 3)).withColumn("patient_keywords", F.concat(F.array(F.lower(F.element_at(X.words("question"), 1))), F.slice(X.words("question"), 3, 3)))
    return b.select("item_id", T.search_text(b).alias("search_text"), T.rerank_query(b, True).alias("rerank_query"), T.search_text(b, False).alias("plain"))


QUERY_TEXTS = rf"""
WITH q AS (SELECT item_id, {_N.format("text")} AS q, string_split({_N.format("text")}, ' ') AS w FROM benchmark
), l AS (SELECT item_id, q, w[1:3] || [lower(w[1])] || w[3:5] AS k FROM q
), d AS (
  SELECT item_id, any_value(q) AS q, string_agg(t, '; ' ORDER BY i) AS terms FROM (
    SELECT item_id, q, i, k[i] AS t FROM (SELECT item_id, q, k, unnest(range(1, len(k) + 1)) AS i FROM l) QUALIFY row_number() OVER (PARTITION BY item_id, lower(k[i]) ORDER BY i) = 1)
  GROUP BY item_id
)
SELECT item_id, q || chr(10) || 'Relevant terms: ' || terms AS search_text, q || chr(10) || 'Relevant medical terms: ' || terms AS rerank_query, q AS plain FROM d
"""


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings")
    corpus = e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    asked = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return search(corpus, asked, RECALL_K)


def recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(spark, sf_dir).select("query_id", "rank", "id", F.round("score", 6).alias("score"))


_RECALL = f"""
e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
), hit AS (
  SELECT q.vec_id AS query_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, e.v) DESC, e.vec_id) AS rank, e.vec_id AS id, list_dot_product(q.v, e.v) AS score
  FROM e q, e WHERE q.vec_id % 50 = 0 QUALIFY rank <= {RECALL_K}
)
"""
RECALL = f"WITH {_RECALL} SELECT query_id, rank::INT AS rank, id, round(score, 6) AS score FROM hit"
#: Passages of the index: several vectors share one, as repeated passages do.
LINKED = "SELECT vec_id, vec_id - vec_id % 3 AS passage_id FROM embeddings"


def reranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = derived(spark, sf_dir, LINKED, "embeddings")
    hits = _hits(spark, sf_dir).join(links, F.col("id") == F.col("vec_id")).select("query_id", F.col("rank").alias("faiss_rank"), "passage_id", F.col("score").alias("faiss_score"))
    kept = T.candidates(hits.withColumnRenamed("faiss_rank", "rank")).withColumnRenamed("rank", "faiss_rank")
    scored = kept.withColumn("rerank_score", ((F.col("passage_id") * 7 + F.col("query_id")) % 4) / 4.0)
    return T.reranked(scored, OUT_K).select("query_id", F.col("rank").cast("int").alias("rank"), "passage_id", F.col("faiss_rank").cast("int").alias("faiss_rank"), "rerank_score")


RERANKED = f"""
WITH {_RECALL}, c AS (
  SELECT query_id, rank, passage_id, score FROM hit JOIN ({LINKED}) l ON l.vec_id = hit.id QUALIFY row_number() OVER (PARTITION BY query_id, passage_id ORDER BY rank) = 1
), s AS (SELECT *, ((passage_id * 7 + query_id) % 4) / 4.0::DOUBLE AS rerank_score FROM c)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, score DESC, rank)::INT AS rank, passage_id, rank::INT AS faiss_rank, rerank_score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, score DESC, s.rank) <= {OUT_K}
"""
DONE = "SELECT concat('  q', CAST(doc_id AS VARCHAR(20)), ' ') AS question_id FROM labels"
ASKED = "SELECT doc_id AS row_idx, CASE WHEN doc_id % 17 = 0 THEN '' ELSE concat('q', CAST(doc_id AS VARCHAR(20))) END AS question_id FROM documents"


def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = T.with_question_ids(derived(spark, sf_dir, ASKED, "documents"))
    return T.pending(asked, derived(spark, sf_dir, DONE, "labels")).select("row_idx", "question_id")


PENDING = f"""
SELECT row_idx, question_id FROM (SELECT row_idx, CASE WHEN question_id <> '' THEN question_id ELSE format('question_{{:06d}}', row_idx) END AS question_id FROM ({ASKED}))
WHERE question_id NOT IN (SELECT trim(question_id) FROM ({DONE}))
"""


def rerank_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _seeds(spark, sf_dir).withColumn("text", F.col("source_text"))
    return d.select("row_idx", F.md5(T.rerank_document(120)).alias("document"), F.round(overlap_score(X.norm_ws("main_topic"), X.norm_ws("text")), 6).alias("overlap"))


RERANK_DOCUMENTS = rf"""
WITH d AS (
  SELECT row_idx, {_N.format("main_topic")} AS topic, {_N.format("source_text")} AS src, array_to_string(list_filter([CASE WHEN {_N.format("main_topic")} <> '' THEN 'Topic: ' || {_N.format("main_topic")} END, CASE WHEN {_N.format("semantic_summary")} <> '' THEN 'Summary: ' || {_N.format("semantic_summary")} END,
    CASE WHEN len(list_filter([w1, w2, w3], lambda x: trim(x) <> '')) > 0 THEN 'Patient keywords: ' || array_to_string(list_filter([{_N.format("w1")}, {_N.format("w2")}, {_N.format("w3")}], lambda x: x <> ''), '; ') END,
    CASE WHEN {_N.format("source_text")} <> '' THEN 'Guideline passage: ' || {_N.format("source_text")} END], lambda x: x IS NOT NULL), chr(10)) AS t FROM ({SEEDS})
)
SELECT row_idx, md5(CASE WHEN length(t) > 120 THEN regexp_replace(regexp_replace(t[1:120], ' [^ ]*$', ''), '^\s+|\s+$', '', 'g') ELSE t END) AS document,
  round(len(list_intersect(list_distinct(string_split(lower(topic), ' ')), list_distinct(string_split(lower(src), ' ')))) / len(list_distinct(string_split(lower(topic), ' '))), 6) AS overlap FROM d
"""


def vector_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.round(V.dot("embedding", F.reverse("embedding")), 6).alias("dot"), F.round(V.dot(V.unit("embedding"), V.unit("embedding")), 6).alias("norm"), F.round(V.yes_share(F.element_at("embedding", 1).cast("double"), F.element_at("embedding", 2).cast("double")), 6).alias("yes"))


VECTOR_MATH = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)
SELECT vec_id, round(list_dot_product(v, list_reverse(v)), 6) AS dot, round(list_dot_product(v, v) / list_dot_product(v, v), 6) AS norm, round(exp(v[1]) / (exp(v[1]) + exp(v[2])), 6) AS yes FROM e
"""

QUERIES = {
    "topic_pools": (topic_pools, TOPIC_POOLS), "distinct_pools": (distinct_pools, DISTINCT_POOLS), "pool_statistics": (pool_statistics, POOL_STATISTICS), "numbered_pools": (numbered_pools, NUMBERED_POOLS), "usable_seeds": (usable_seeds, USABLE_SEEDS),
    "index_rows": (index_rows, INDEX_ROWS), "query_texts": (query_texts, QUERY_TEXTS), "recall_top_k": (recall, RECALL), "reranked": (reranked, RERANKED), "pending_questions": (pending, PENDING), "rerank_documents": (rerank_documents, RERANK_DOCUMENTS), "vector_math": (vector_math, VECTOR_MATH),
}
