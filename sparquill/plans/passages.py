"""Queries over passages: text, segmentation, reference scores, headings, chunks, ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.functions import reference_score as R
from sparquill.functions import text as X
from sparquill.functions import values as V
from sparquill.operators import chunking
from sparquill.operators.retrieval import rows_between
from sparquill.runtime import read

#: Documents with references, years, journals and brackets added by id; both engines run this text.
CITED = """
SELECT doc_id, source, text, concat(text,
  CASE WHEN doc_id % 3 = 0 THEN concat(' doi 10.1234/x', CAST(doc_id AS VARCHAR(20))) ELSE '' END,
  CASE WHEN doc_id % 5 = 0 THEN ' see https://a.example/b ' ELSE '' END,
  CASE WHEN doc_id % 4 = 1 THEN ' Smith J, Jones K, Miller AB. et al. 2001; 2002; 2003 ' ELSE '' END,
  CASE WHEN doc_id % 8 = 1 THEN ' 1999 2010 2015 ' ELSE '' END,
  CASE WHEN doc_id % 7 = 2 THEN ' [1] [2, 3] [4-6] ' ELSE '' END,
  CASE WHEN doc_id % 6 = 4 THEN ' Ann Intern Med ' ELSE '' END) AS cited
FROM documents
"""
#: Lines: headings, questions, references, numbers; whole texts for some, which give a line a sentence.
TITLED = """
SELECT doc_id, CASE doc_id % 9
  WHEN 0 THEN text WHEN 1 THEN 'References' WHEN 2 THEN 'References are listed below.' WHEN 3 THEN 'Key Recommendations:' WHEN 4 THEN concat(CAST(doc_id % 30 AS VARCHAR(9)), '.2 Treatment of adults')
  WHEN 5 THEN concat('what now', CAST(doc_id AS VARCHAR(20)), '?') WHEN 6 THEN text WHEN 7 THEN '' ELSE 'bibliography of all the works that we have cited here' END AS line
FROM documents
"""


def derived(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    """The shared SQL text over tables of the folder."""
    views = {t: read(spark, sf_dir, t) for t in tables}
    sql = sql.replace("{", "{{").replace("}", "}}")
    for t in tables:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    return spark.sql(sql, **views)


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", X.count_words("text").cast("long").alias("n_words"), F.round(X.punctuation_share("text"), 9).alias("punctuation"))


WORD_COUNTS = r"""
SELECT doc_id, len(regexp_extract_all(regexp_replace(text, '[^\x00-\x7F\P{L}]', '_', 'g'), '\b[0-9A-Za-z][0-9A-Za-z''\-]*\b'))::BIGINT AS n_words,
       round((length(text) - length(translate(text, '.,;:()[]', ''))) / greatest(length(text), 1), 9) AS punctuation
FROM documents
"""
CLEANED = "SELECT doc_id, concat('  ', text, chr(13), '  x ', chr(9), '  hy-', chr(10), 'phen', chr(10), '  ', chr(10), ' end ') AS t FROM documents"


def clean_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = derived(spark, sf_dir, CLEANED, "documents")
    return d.select("doc_id", F.md5(X.clean_text("t")).alias("cleaned"), F.md5(X.norm_ws("t")).alias("one_line"), F.md5(X.normalize_page("t")).alias("page"), F.md5(X.truncate("t", 80)).alias("cut"), F.md5(X.cut_at_word("t", 90)).alias("at_word"))


CLEAN_TEXTS = rf"""
WITH d AS (SELECT doc_id, t, trim(regexp_replace(t, '\s+', ' ', 'g')) AS o FROM ({CLEANED}))
SELECT doc_id,
  md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(t, chr(13), chr(10)), '[ \t]+', ' ', 'g'), '\s+\n', chr(10), 'g'), '\n\s+', chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS cleaned,
  md5(o) AS one_line,
  md5(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(t, chr(13), chr(10)), '-\n([a-z])', '\1', 'g'), '\n\s*\n+', chr(1), 'g'), '\n+', ' ', 'g'), '[ \t]+', ' ', 'g'), '^\s+|\s+$', '', 'g'), chr(1), chr(10) || chr(10))) AS page,
  md5(CASE WHEN length(o) > 80 THEN rtrim(o[1:80]) || ' ...[truncated]' ELSE o END) AS cut,
  md5(CASE WHEN length(t) > 90 THEN regexp_replace(regexp_replace(t[1:90], ' [^ ]*$', ''), '^\s+|\s+$', '', 'g') ELSE t END) AS at_word
FROM d
"""


def sentence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", F.posexplode(X.sentences("text")).alias("i", "sentence")).select("doc_id", F.col("i").cast("long").alias("i"), F.md5("sentence").alias("sentence"), F.length("sentence").cast("long").alias("n"))


_SENTENCES = r"list_filter(list_transform(string_split(regexp_replace(trim(regexp_replace({0}, '\s+', ' ', 'g')), '([.!?])\s+', '\1' || chr(31), 'g'), chr(31)), lambda s: trim(s)), lambda s: s <> '')"
SENTENCE_ROWS = f"""
SELECT doc_id, i - 1 AS i, md5(s[i]) AS sentence, length(s[i])::BIGINT AS n
FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, {_SENTENCES.format("text")} AS s FROM documents))
"""


def tail_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(X.tail_overlap("text", 2, 12)).alias("overlap"))


TAIL_OVERLAPS = f"""
WITH d AS (SELECT doc_id, array_to_string({_SENTENCES.format("text")}[-2:], ' ') AS o FROM documents)
SELECT doc_id, md5(array_to_string(string_split(o, ' ')[-12:], ' ')) AS overlap FROM d
"""


def reference_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = derived(spark, sf_dir, CITED, "documents")
    return d.select("doc_id", R.reference_score("cited").alias("score"), R.reference_score("text").alias("plain_score"), R.is_reference_like("cited").alias("is_reference_like"))


_ASCII = r"regexp_replace({0}, '[^\x00-\x7F\P{{L}}]', '_', 'g')"


def _score_sql(column: str) -> str:
    s = f"trim(regexp_replace({column}, '\\s+', ' ', 'g'))"
    a = _ASCII.format(s)
    n = lambda p: f"len(regexp_extract_all({a}, '{p}'))"
    wc = f"greatest(1, {n(chr(92) + 'b[0-9A-Za-z][0-9A-Za-z' + chr(39) * 2 + chr(92) + '-]*' + chr(92) + 'b')})"
    doi, years = n(R.DOI), n(R.YEAR)
    rules = [
        (f"{doi} >= 1", 35), (f"{doi} >= 2", 25), (f"regexp_matches({s}, '{R.URL}')", 20), (f"regexp_matches({a}, '{R.ET_AL}')", 25), (f"{years} >= 3", 20), (f"{years} >= 5", 15),
        (f"len(regexp_extract_all({s}, '\\[[0-9,\\s\\-]+\\]')) >= 3", 20), (f"regexp_matches({a}, '(?i)\\b({'|'.join(R.JOURNALS)})\\b')", 15), (f"regexp_matches({a}, '\\b{R.AUTHOR}(?:,\\s*{R.AUTHOR})+')", 30),
        (f"(length({s}) - length(translate({s}, '.,;:()[]', ''))) / greatest(length({s}), 1) > 0.12 AND {wc} < 180", 15), (f"{wc} < 120 AND {years} >= 3", 15),
    ]
    return f"CASE WHEN length({s}) = 0 THEN 1.0 ELSE least(100, " + " + ".join(f"CASE WHEN {c} THEN {p} ELSE 0 END" for c, p in rules) + ") / 100.0::DOUBLE END"


REFERENCE_SCORES = f"""
SELECT doc_id, ({_score_sql("cited")})::DOUBLE AS score, ({_score_sql("text")})::DOUBLE AS plain_score, ({_score_sql("cited")}) >= 0.75 AS is_reference_like
FROM ({CITED})
"""


def reference_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = R.keep_passages(derived(spark, sf_dir, CITED, "documents"), "cited")
    return kept.groupBy("source").agg(F.count("*").alias("n_kept"), F.sum(X.count_words("cited")).alias("n_words"))


REFERENCE_FILTER = rf"""
SELECT source, count(*) AS n_kept, sum(len(regexp_extract_all(regexp_replace(cited, '[^\x00-\x7F\P{{L}}]', '_', 'g'), '\b[0-9A-Za-z][0-9A-Za-z''\-]*\b')))::BIGINT AS n_words
FROM ({CITED}) WHERE ({_score_sql("cited")}) < 0.75 GROUP BY source
"""


def headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = derived(spark, sf_dir, TITLED, "documents")
    d = d.select("doc_id", F.explode(F.when((F.col("doc_id") % 9).isin(0, 6), X.sentences("line")).otherwise(F.array("line"))).alias("line"))
    return d.select("doc_id", R.is_reference_heading("line").alias("is_reference"), R.is_section_heading("line").alias("is_section"))


_H = "|".join(R.REFERENCE_HEADINGS.split("|"))
HEADINGS = rf"""
WITH d AS (SELECT doc_id, trim(regexp_replace(line, '\s+', ' ', 'g')) AS s FROM (
  SELECT doc_id, unnest(CASE WHEN doc_id % 9 IN (0, 6) THEN {_SENTENCES.format("line")} ELSE [line] END) AS line FROM ({TITLED})))
SELECT doc_id, s <> '' AND (regexp_matches(s[1:80], '(?i)^\s*({_H})\s*$') OR len(string_split(s, ' ')) <= 6 AND regexp_matches(s[1:80], '(?i)^\s*({_H})\b')) AS is_reference,
  s <> '' AND (trim(lower(s), ' :.-') IN ({", ".join(f"'{h}'" for h in R.SECTION_HEADINGS)}) OR regexp_matches(s, '^\d+(\.\d+)*\.?\s+[A-Z][A-Za-z ,/\-:]{{2,100}}$')
    OR len(regexp_extract_all(regexp_replace(s, '[^\x00-\x7F\P{{L}}]', '_', 'g'), '\b[0-9A-Za-z][0-9A-Za-z''\-]*\b')) <= 10 AND length(s) <= 100 AND NOT ends_with(s, '.') AND regexp_matches(regexp_replace(s, '[^A-Za-z]', '', 'g')[1:10], '[A-Z]')) AS is_section
FROM d
"""
#: Pages with headings and, for some documents, a reference section in the middle; the last page holds all the rest of a text.
PAGED = """
SELECT doc_id, source, concat('Introduction. ', substr(text, 1, 900)) AS page1, concat(CASE WHEN doc_id % 4 = 0 THEN 'Methods? ' ELSE '' END, substr(text, 901, 2500)) AS page2,
  concat(CASE WHEN doc_id % 6 = 1 THEN 'References! ' ELSE 'Results! ' END, substr(text, 3401)) AS page3 FROM documents
"""


def _paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = derived(spark, sf_dir, PAGED, "documents")
    return d.select(F.format_string("g%06d", "doc_id").alias("guideline_id"), F.col("source").alias("source_pdf"), F.array("page1", "page2", "page3").alias("pages"))


def unit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.unit_rows(_paged(spark, sf_dir)).select("guideline_id", F.col("page").cast("long").alias("page"), F.col("para").cast("long").alias("para"), F.md5("section_title").alias("section"), "in_references", F.col("words").cast("long").alias("words"))


_WC = r"len(regexp_extract_all(regexp_replace({0}, '[^\x00-\x7F\P{{L}}]', '_', 'g'), '\b[0-9A-Za-z][0-9A-Za-z''\-]*\b'))"
UNITS_SQL = rf"""
WITH p AS (
  SELECT format('g{{:06d}}', doc_id) AS guideline_id, source AS source_pdf, unnest([1, 2, 3]) AS page, unnest([page1, page2, page3]) AS t FROM ({PAGED})
), c AS (
  SELECT guideline_id, source_pdf, page, regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(t, chr(13), chr(10)), '[ \t]+', ' ', 'g'), '\s+\n', chr(10), 'g'), '\n\s+', chr(10), 'g'), '^\s+|\s+$', '', 'g') AS t FROM p
), s AS (
  SELECT guideline_id, source_pdf, page, list_filter(list_transform(string_split(regexp_replace(t, '([。.!?])\s+', '\1' || chr(31), 'g'), chr(31)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS l FROM c
), u AS (
  SELECT guideline_id, source_pdf, page, i AS para, trim(regexp_replace(l[i], '\s+', ' ', 'g')) AS text FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM s)
), f AS (
  SELECT *, {_WC.format("text")}::BIGINT AS words,
    regexp_matches(text[1:80], '(?i)^\s*({_H})\s*$') OR len(string_split(text, ' ')) <= 6 AND regexp_matches(text[1:80], '(?i)^\s*({_H})\b') AS is_ref,
    trim(lower(text), ' :.-') IN ({", ".join(f"'{h}'" for h in R.SECTION_HEADINGS)}) OR regexp_matches(text, '^\d+(\.\d+)*\.?\s+[A-Z][A-Za-z ,/\-:]{{2,100}}$')
      OR {_WC.format("text")} <= 10 AND length(text) <= 100 AND NOT ends_with(text, '.') AND regexp_matches(regexp_replace(text, '[^A-Za-z]', '', 'g')[1:10], '[A-Z]') AS is_head
  FROM u WHERE text <> ''
)
"""
UNIT_ROWS = UNITS_SQL + """
SELECT guideline_id, page::BIGINT AS page, para::BIGINT AS para, words,
  md5(coalesce(last_value(CASE WHEN is_head AND NOT is_ref THEN text[1:160] END IGNORE NULLS) OVER w, '')) AS section, max(is_ref) OVER w AS in_references
FROM f WINDOW w AS (PARTITION BY guideline_id ORDER BY page, para ROWS UNBOUNDED PRECEDING)
"""
_CHUNKING = {"min_words": 40, "max_words": 90, "overlap_sentences": 1}


def chunked_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = chunking.passages(_paged(spark, sf_dir), **_CHUNKING)
    return rows.select("guideline_id", "passage_id", F.md5("section_title").alias("section"), *(F.col(c).cast("long").alias(c) for c in ("page_start", "page_end", "para_start", "para_end", "word_count")), F.md5("text").alias("text"), "reference_list_score")


#: One recursion step per unit: (buffer, its words and span, section) and what the step emits; then tail merges, chunk by chunk.
CHUNKED = UNITS_SQL.replace("WITH p AS", "WITH RECURSIVE p AS", 1) + rf"""
, o AS (SELECT *, row_number() OVER (PARTITION BY guideline_id ORDER BY page, para) AS k, count(*) OVER (PARTITION BY guideline_id) AS n FROM f
), cut AS (SELECT guideline_id, coalesce(min(CASE WHEN is_ref THEN k END), any_value(n) + 1) AS stop FROM o GROUP BY guideline_id
), z AS (
  SELECT o.guideline_id, k, page, para, text, words, is_head FROM o JOIN cut USING (guideline_id) WHERE k < stop
  UNION ALL SELECT guideline_id, stop, 0, 0, '', 0, true FROM cut
), fold AS (
  SELECT guideline_id, 0::BIGINT AS k, ''::VARCHAR AS buf, 0::BIGINT AS bw, [0, 0, 0, 0]::BIGINT[] AS span, ''::VARCHAR AS section, NULL::STRUCT(section VARCHAR, t VARCHAR, w BIGINT, span BIGINT[]) AS emitted FROM cut
  UNION ALL
  SELECT guideline_id, k,
    CASE WHEN is_head THEN '' WHEN full_ THEN overlap ELSE joined END,
    CASE WHEN is_head THEN 0 WHEN full_ THEN CASE WHEN overlap = '' THEN 0 ELSE {_WC.format("overlap")} END ELSE jw END,
    CASE WHEN full_ THEN [page, page, para, para] ELSE span2 END,
    CASE WHEN is_head THEN text[1:160] ELSE section END,
    CASE WHEN is_head THEN CASE WHEN buf <> '' THEN {{'section': section, 't': buf, 'w': bw, 'span': span}} END WHEN full_ THEN {{'section': section, 't': joined, 'w': jw, 'span': span2}} END
  FROM (
    SELECT *, NOT is_head AND jw >= {_CHUNKING["max_words"]} AS full_, array_to_string(string_split({_SENTENCES.format("joined")}[-1], ' ')[-40:], ' ') AS overlap
    FROM (
      SELECT f.guideline_id, z.k, f.buf, f.bw, f.span, f.section, z.page, z.para, z.text, z.is_head, CASE WHEN buf = '' THEN z.text ELSE buf || ' ' || z.text END AS joined, bw + z.words AS jw,
        CASE WHEN buf = '' THEN [z.page, z.page, z.para, z.para] ELSE [span[1], z.page, span[3], z.para] END AS span2
      FROM fold f JOIN z ON z.guideline_id = f.guideline_id AND z.k = f.k + 1
    )
  )
), raw AS (
  SELECT guideline_id, k, emitted.section AS section, emitted.t AS t, emitted.w AS w, emitted.span AS span, {_score_sql("emitted.t")} AS score FROM fold WHERE emitted IS NOT NULL
), kept AS (SELECT *, row_number() OVER (PARTITION BY guideline_id ORDER BY k) AS r FROM raw WHERE score < 0.75
), merged AS (
  SELECT guideline_id, r, 1::BIGINT AS g, section, t, w, span FROM kept WHERE r = 1
  UNION ALL
  SELECT guideline_id, r, CASE WHEN j THEN g ELSE g + 1 END, s2, CASE WHEN j THEN t || ' ' || t2 ELSE t2 END, CASE WHEN j THEN w + w2 ELSE w2 END, CASE WHEN j THEN [span[1], span2[2], span[3], span2[4]] ELSE span2 END
  FROM (
    SELECT m.guideline_id, n.r, m.g, m.t, m.w, m.span, n.section AS s2, n.t AS t2, n.w AS w2, n.span AS span2, n.w < {_CHUNKING["min_words"]} AND m.section = n.section AND m.w + n.w <= {_CHUNKING["max_words"] + 80} AS j
    FROM merged m JOIN kept n ON n.guideline_id = m.guideline_id AND n.r = m.r + 1
  )
), final AS (
  SELECT guideline_id, g, last(section ORDER BY r) AS section, last(t ORDER BY r) AS t, last(w ORDER BY r) AS w, last(span ORDER BY r) AS span FROM merged GROUP BY guideline_id, g
), good AS (SELECT *, ({_score_sql("t")})::DOUBLE AS score FROM final)
SELECT guideline_id, guideline_id || '_p' || format('{{:05d}}', row_number() OVER (PARTITION BY guideline_id ORDER BY g)) AS passage_id, md5(section) AS section,
  span[1] AS page_start, span[2] AS page_end, span[3] AS para_start, span[4] AS para_end, w AS word_count, md5(t) AS text, score AS reference_list_score
FROM good WHERE score < 0.75
"""


def document_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, counts = chunking.passages(_paged(spark, sf_dir), **_CHUNKING)
    return counts.select("guideline_id", *(F.col(c).cast("long").alias(c) for c in counts.columns if c not in ("guideline_id", "source_pdf")))


#: The steps of CHUNKED, counted per document.
DOCUMENT_COUNTS = CHUNKED[: CHUNKED.rindex("\nSELECT guideline_id")] + """
, n AS (SELECT guideline_id, count(*) AS raw, count(*) FILTER (WHERE score < 0.75) AS kept FROM raw GROUP BY guideline_id
), g AS (SELECT guideline_id, count(*) AS merged, count(*) FILTER (WHERE score < 0.75) AS good FROM good GROUP BY guideline_id
), x AS (SELECT guideline_id, count(*) AS units FROM o GROUP BY guideline_id)
SELECT format('g{:06d}', doc_id) AS guideline_id, 3::BIGINT AS num_pages, coalesce(raw, 0)::BIGINT AS num_raw_candidate_chunks, coalesce(units - stop + 1, 0)::BIGINT AS removed_by_ref_heading_zone, coalesce(raw - kept, 0)::BIGINT AS removed_by_regex_ref,
  coalesce(kept, 0)::BIGINT AS num_kept_chunks_before_tail_merge, coalesce(merged - good, 0)::BIGINT AS removed_by_regex_ref_after_tail_merge, coalesce(good, 0)::BIGINT AS num_kept_chunks_after_tail_merge
FROM documents d LEFT JOIN n ON n.guideline_id = format('g{:06d}', doc_id) LEFT JOIN g ON g.guideline_id = format('g{:06d}', doc_id) LEFT JOIN x ON x.guideline_id = format('g{:06d}', doc_id) LEFT JOIN cut ON cut.guideline_id = format('g{:06d}', doc_id)
"""
_TOTALS = ("num_pages", "num_raw_candidate_chunks", "removed_by_ref_heading_zone", "removed_by_regex_ref", "num_kept_chunks_before_tail_merge", "removed_by_regex_ref_after_tail_merge", "num_kept_chunks_after_tail_merge")


def chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, counts = chunking.passages(_paged(spark, sf_dir), **_CHUNKING)
    return chunking.corpus_totals(counts).select("num_documents", *_TOTALS)


CHUNK_COUNTS = f"SELECT count(*) AS num_documents, {', '.join(f'sum({c})::BIGINT AS {c}' for c in _TOTALS)} FROM ({DOCUMENT_COUNTS})"
NAMED = """
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN concat(source, '_p', CAST(doc_id AS VARCHAR(20))) WHEN doc_id % 3 = 1 THEN concat('x', CAST(doc_id AS VARCHAR(20))) ELSE '' END AS pid, CASE WHEN doc_id % 4 = 0 THEN source ELSE '' END AS gid,
  CASE WHEN doc_id % 5 = 0 THEN 'passage-x' ELSE concat('passage-', CAST(doc_id AS VARCHAR(20))) END AS custom, concat('/data/job_0000', CAST(10 + doc_id % 80 AS VARCHAR(9)), '_000', CAST(100 + doc_id % 800 AS VARCHAR(9)), '.jsonl') AS file FROM documents
"""


def ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = derived(spark, sf_dir, NAMED, "documents")
    return d.select(
        "doc_id", V.group_of_passage("gid", "pid").alias("pool_group"), V.document_of_passage("pid", "gid").alias("index_group"), V.number_after("custom", "passage").alias("row_number"),
        V.range_of_file("file")["start"].alias("range_start"), V.range_of_file("file")["end"].alias("range_end"), V.padded_id("grp_", "doc_id").alias("group_id"), V.passage_id("gid", "doc_id").alias("passage_id"),
    )


IDS = rf"""
SELECT doc_id, CASE WHEN gid <> '' THEN gid WHEN contains(pid, '_p') THEN split_part(pid, '_p', 1) ELSE 'unknown' END AS pool_group,
  CASE WHEN gid <> '' THEN gid WHEN contains(pid, '_') THEN split_part(pid, '_', 1) ELSE '' END AS index_group, try_cast(nullif(regexp_extract(custom, '^passage-(-?\d+)$', 1), '') AS BIGINT) AS row_number,
  regexp_extract(file, '_(\d{{6}})_(\d{{6}})\.jsonl$', 1)::INT AS range_start, regexp_extract(file, '_(\d{{6}})_(\d{{6}})\.jsonl$', 2)::INT AS range_end, format('grp_{{:06d}}', doc_id) AS group_id, gid || format('_p{{:05d}}', doc_id) AS passage_id
FROM ({NAMED})
"""


def row_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").withColumn("row_idx", F.col("doc_id"))
    return rows_between(d, 100, 164).select("row_idx", "source")


ROW_SLICE = "SELECT doc_id AS row_idx, source FROM documents WHERE doc_id >= 100 AND doc_id < 164"

QUERIES = {
    "word_counts": (word_counts, WORD_COUNTS), "clean_texts": (clean_texts, CLEAN_TEXTS), "sentence_rows": (sentence_rows, SENTENCE_ROWS), "tail_overlaps": (tail_overlaps, TAIL_OVERLAPS), "reference_scores": (reference_scores, REFERENCE_SCORES),
    "reference_filter": (reference_filter, REFERENCE_FILTER), "headings": (headings, HEADINGS), "unit_sections": (unit_rows, UNIT_ROWS), "chunked_passages": (chunked_passages, CHUNKED), "chunk_counts": (chunk_counts, CHUNK_COUNTS), "document_counts": (document_counts, DOCUMENT_COUNTS), "passage_ids": (ids, IDS), "row_slice": (row_slice, ROW_SLICE),
}
