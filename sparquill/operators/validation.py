"""Validation of model output: annotations, questions, answers and claims as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparquill.functions.citations import cited_sentences, citation_ids, clamp, marks, sentence_number, without_marks
from sparquill.functions.text import clean_list, first_text, norm_ws, text
from sparquill.functions.values import one_of, padded_id
from sparquill.operators.tasks import chosen_passages

# --- fixed values: enumerations and phrases of the data model ----------------------------------
QUESTION_TYPES = (
    "treatment_choice", "medication_use", "safety_or_side_effects", "eligibility", "diagnosis_or_screening", "monitoring_or_follow_up",
    "recovery_or_aftercare", "when_to_seek_care", "risk_or_prognosis", "procedure_preparation", "lifestyle_or_self_management", "other",
)
PERSPECTIVES = ("patient_self", "caregiver_or_family", "general_health_info_seeker")
ANSWER_ROLES = (
    "direct_answer", "eligibility_or_condition", "benefit_or_effectiveness", "risk_or_safety", "monitoring_or_follow_up", "procedure_or_preparation",
    "medication_use", "diagnosis_or_screening", "lifestyle_or_self_management", "shared_decision_making", "equity_or_communication",
    "evidence_limitation", "patient_action_supported_by_evidence",
)
FORBIDDEN_PHRASES = (
    "according to the guideline", "according to this guideline", "according to the passage", "according to this passage", "according to the document",
    "based on these passages", "this guideline", "this passage", "the passage", "the guideline",
)
NO_QUESTION = "No valid patient-style retrievable question remained after validation."
# ---------------------------------------------------------------------------------------------


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def valid_seeds(ok: DataFrame) -> DataFrame:
    """Annotations with their passage's provenance; lists are emptied if the passage is not usable.

    The model's passage id wins over the source's.
    """
    p, s = F.col("payload"), F.col("source")
    use = F.coalesce(p["usable"], F.lit(False))
    keep = lambda c, n: F.when(use, F.slice(clean_list(c), 1, n)).otherwise(_none("string"))
    return ok.select(
        F.when(F.length(text(p["passage_id"])) > 0, p["passage_id"]).otherwise(text(s["passage_id"])).alias("passage_id"),
        use.alias("usable"),
        *(norm_ws(p[c]).alias(c) for c in ("discard_reason", "content_type", "main_topic", "semantic_summary")),
        keep(p["question_angles"], 4).alias("question_angles"),
        keep(p["patient_language_keywords"], 8).alias("patient_language_keywords"),
        F.col("row_idx").alias("sample_idx"),
        *(s[c].alias(c) for c in ("guideline_id", "source_pdf", "section_title", "page_start", "page_end", "word_count", "reference_list_score")),
        text(s["text"]).alias("source_text"),
    )


def mentions_source(question: Column) -> Column:
    low = F.lower(question)
    return F.exists(F.array(*map(F.lit, FORBIDDEN_PHRASES)), lambda bad: low.contains(bad))


def valid_questions(ok: DataFrame) -> DataFrame:
    """``(pool_id, guideline_id, questions, skip_reason)``: at most one valid question per pool, else why not."""
    p, s = F.col("payload"), F.col("source")
    keywords = lambda q: F.slice(clean_list(q["patient_keywords"]), 1, 8)
    anchors = lambda q: F.slice(clean_list(q["retrieval_anchor_terms"]), 1, 3)
    valid = lambda q: (F.length(norm_ws(q["question"])) > 0) & ~mentions_source(norm_ws(q["question"])) & ((F.size(anchors(q)) > 0) | (F.size(keywords(q)) > 0))
    out = F.transform(
        F.filter(F.slice(F.coalesce(p["questions"], F.array()), 1, 1), valid),
        lambda q: F.struct(
            F.concat(padded_id("q_", F.col("row_idx")), F.lit("_01")).alias("question_id"), norm_ws(q["question"]).alias("question"),
            one_of(q["question_type"], QUESTION_TYPES, "other").alias("question_type"), one_of(q["perspective"], PERSPECTIVES, "general_health_info_seeker").alias("perspective"),
            keywords(q).alias("patient_keywords"), F.when(F.size(anchors(q)) > 0, anchors(q)).otherwise(F.slice(keywords(q), 1, 3)).alias("retrieval_anchor_terms"),
        ),
    )
    pick = lambda a, b: F.when(F.length(norm_ws(a)) > 0, norm_ws(a)).otherwise(norm_ws(b))
    rows = ok.select("row_idx", pick(p["pool_id"], s["group_id"]).alias("pool_id"), pick(p["guideline_id"], s["guideline_id"]).alias("guideline_id"), out.alias("questions"), norm_ws(p["skip_reason"]).alias("skip_reason"))
    return rows.withColumn("skip_reason", F.when((F.size("questions") == 0) & (F.length("skip_reason") == 0), NO_QUESTION).otherwise(F.col("skip_reason")))


def question_rows(validated: DataFrame) -> DataFrame:
    """One row per question, without the pool's fields."""
    return validated.select(F.explode("questions").alias("q")).select("q.*")


def _role(given: Column, ordinal: Column) -> Column:
    return one_of(given, ANSWER_ROLES, F.when(ordinal == 1, "direct_answer").otherwise("evidence_limitation"))


def answer_sentences(answer: Column, sentences: Column, n_passages: Column) -> Column:
    """Cited sentences of an answer, numbered ``s1``...: structured ones, or pieces of the text if none has a citation.

    Citations in the text win over the field's; both are clamped to the passages.  The default role
    depends on the sentence's place before others are dropped.
    """
    raw = F.transform(
        F.coalesce(sentences, F.array().cast("array<struct<text:string,citations:array<int>,role:string>>")),
        lambda s, i: F.struct(
            norm_ws(s["text"]).alias("text"),
            F.when(F.size(clamp(marks(norm_ws(s["text"])), n_passages)) > 0, clamp(marks(norm_ws(s["text"])), n_passages)).otherwise(clamp(s["citations"], n_passages)).alias("citations"),
            _role(norm_ws(s["role"]), i + 1).alias("role"),
        ),
    )
    kept = F.filter(raw, lambda s: (F.length(s["text"]) > 0) & (F.size(s["citations"]) > 0))
    pieces = F.transform(cited_sentences(answer), lambda t, i: F.struct(F.concat(F.lit("s"), (i + 1).cast("string")).alias("sentence_id"), t.alias("text"), clamp(marks(t), n_passages).alias("citations"), F.when(i == 0, "direct_answer").otherwise("evidence_limitation").alias("role")))
    fallback = F.filter(pieces, lambda s: (F.length(s["text"]) > 0) & (F.size(s["citations"]) > 0))
    numbered = F.transform(kept, lambda s, i: F.struct(F.concat(F.lit("s"), (i + 1).cast("string")).alias("sentence_id"), s["text"].alias("text"), s["citations"].alias("citations"), s["role"].alias("role")))
    return F.when(F.size(kept) > 0, numbered).otherwise(fallback)


def valid_answers(ok: DataFrame, n_passages: Column, *keep: str) -> DataFrame:
    """``(row_idx, question_id, answer_text, answer_sentences, evidence_gaps, error)`` and the columns to ``keep``.

    An answer fails as a whole without text, without a cited sentence, or if a kept sentence shows no
    citation mark.  Gaps are capped at five before blank ones go.
    """
    p, s = F.col("payload"), F.col("source")
    rows = ok.select(
        "row_idx",
        F.when(F.length(norm_ws(s["question_id"])) > 0, norm_ws(s["question_id"])).otherwise(padded_id("qrow_", F.col("row_idx"))).alias("question_id"),
        norm_ws(p["answer_text"]).alias("answer_text"),
        answer_sentences(p["answer_text"], p["answer_sentences"], n_passages).alias("answer_sentences"),
        F.filter(
            F.transform(F.slice(F.coalesce(p["evidence_gaps"], F.array()), 1, 5), lambda g: F.struct(norm_ws(g["missing_issue"]).alias("missing_issue"), norm_ws(g["reason"]).alias("reason"))),
            lambda g: (F.length(g["missing_issue"]) > 0) | (F.length(g["reason"]) > 0),
        ).alias("evidence_gaps"),
        *keep,
    )
    error = (
        F.when(F.length("answer_text") == 0, "missing answer_text")
        .when(F.size("answer_sentences") == 0, "no cited sentence")
        .when(F.exists("answer_sentences", lambda x: F.size(marks(x["text"])) == 0), "sentence without visible citation")
    )
    return rows.withColumn("error", error)


#: Fields of a passage that an answer cites, in order, after its number.
_CITED = {"text": "string", "passage_id": "string", "guideline_id": "string", "main_topic": "string", "section": "string", "rerank_score": "double", "faiss_rank": "long", "faiss_score": "double", "page_start": "long", "page_end": "long", "source_pdf": "string"}


def _fields_of(df: DataFrame, column: str) -> list[str]:
    """Names of the struct fields of an array column such as ``source.passages``; none if there is no such column."""
    kind = df.schema
    for name in column.split("."):
        if name not in getattr(kind, "fieldNames", list)():
            return []
        kind = kind[name].dataType
    return kind.elementType.fieldNames() if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) else []


def passages_with_pid(passages: Column, have: list[str]) -> Column:
    """Passages numbered from 1 as ``pid``, for citations; ``have`` names their fields, the others become null."""
    value = lambda x, f, kind: (x[f] if f in have else F.lit(None)).cast(kind).alias(f)
    return F.transform(F.coalesce(passages, F.array()), lambda x, i: F.struct((i + 1).cast("int").alias("pid"), *(value(x, f, k) for f, k in _CITED.items())))


def citable_passages(df: DataFrame, passages: str = "passages", fallback: str = "top_passages") -> Column:
    """The row's ``passages`` with their own ``pid`` (their place where that is no number), else its ``fallback`` numbered anew; empty without both."""
    have, other = _fields_of(df, passages), _fields_of(df, fallback)
    none = F.array().cast("array<struct<pid:int," + ",".join(f"{f}:{k}" for f, k in _CITED.items()) + ">>")
    anew = passages_with_pid(F.col(fallback), other) if other else none
    if not have:
        return anew
    given = F.filter(F.coalesce(F.col(passages), F.array()), lambda x: x.isNotNull())
    pid = lambda x, i: F.coalesce(x["pid"].try_cast("int"), (i + 1).cast("int")) if "pid" in have else (i + 1).cast("int")
    own = F.transform(passages_with_pid(given, have), lambda x, i: x.withField("pid", pid(F.element_at(given, i + 1), i)).withField("text", F.coalesce(x["text"], F.lit(""))))
    return F.when(F.size(given) > 0, own).otherwise(anew)


def answer_records(ok: DataFrame, top_n: int = 5) -> DataFrame:
    """Output records of answers, with ``error`` (null for those that hold): question fields, answer, the passages shown and the same numbered for citations."""
    have = ok.schema["source"].dataType.fieldNames()
    shown = "source.retrieved_passages"
    passages = chosen_passages(top_n, shown) if _fields_of(ok, shown) else F.array().cast("array<struct<text:string>>")
    field = lambda name, kind: (F.col(f"source.{name}") if name in have else F.lit(None)).cast(kind)
    words = lambda name: F.coalesce(field(name, "array<string>"), F.array().cast("array<string>")).alias(name)
    extra = ok.select(
        "row_idx", *(norm_ws(field(f, "string")).alias(f) for f in ("question", "question_type", "perspective")),
        words("patient_keywords"), words("retrieval_anchor_terms"), passages.alias("top_passages"),
        passages_with_pid(passages, _fields_of(ok, shown) or ["text"]).alias("passages"),
        F.struct("payload", "source").alias("_ok"),
    )
    checked = valid_answers(extra.select("*", "_ok.*"), F.size("top_passages"), "question", "question_type", "perspective", "patient_keywords", "retrieval_anchor_terms", "top_passages", "passages")
    return checked.select(
        F.col("row_idx").alias("question_idx"), "question_id", "question", "question_type", "perspective", "patient_keywords", "retrieval_anchor_terms",
        F.col("answer_text").alias("answer"), "answer_text", "answer_sentences", "evidence_gaps", "top_passages", "passages", "error",
    )


def sentences_for_claims(answer: Column | str, sentences: Column | str) -> Column:
    """Cited sentences ``(sentence_id, raw_sentence, sentence_text, citation_ids, role)`` of an answer.

    Structured sentences first, in order of their own numbers and renumbered; else pieces of the text that
    end with citations; else the whole text if it cites anything.
    """
    given = F.col(sentences) if isinstance(sentences, str) else sentences
    own = F.transform(
        F.coalesce(given, F.array().cast("array<struct<sentence_id:string,text:string,citations:array<int>,role:string>>")),
        lambda s, i: F.struct(
            sentence_number(s["sentence_id"], i + 1).alias("n"), i.alias("i"), norm_ws(s["text"]).alias("raw"), norm_ws(s["role"]).alias("role"),
            F.slice(F.when(F.size(citation_ids(s["text"])) > 0, citation_ids(s["text"])).otherwise(F.filter(F.coalesce(s["citations"], _none("int")), lambda c: c > 0)), 1, 3).alias("ids"),
        ),
    )
    own = F.array_sort(F.filter(own, lambda s: (F.length(s["raw"]) > 0) & (F.size(s["ids"]) > 0)))
    row = lambda raw, i, ids, role: F.struct((i + 1).cast("int").alias("sentence_id"), raw.alias("raw_sentence"), without_marks(raw).alias("sentence_text"), ids.alias("citation_ids"), role.alias("role"))
    structured = F.transform(own, lambda s, i: row(s["raw"], i, s["ids"], s["role"]))
    whole = norm_ws(answer)
    usable = lambda a: F.filter(a, lambda s: (F.length(s["sentence_text"]) > 0) & (F.size(s["citation_ids"]) > 0))
    pieces = cited_sentences(whole)
    split = F.transform(pieces, lambda t, i: row(t, i, F.slice(citation_ids(t), 1, 3), F.lit("")))
    single = F.array(row(whole, F.lit(0), F.slice(citation_ids(whole), 1, 3), F.lit("")))
    return F.when(F.size(structured) > 0, structured).when(F.size(pieces) > 0, usable(split)).otherwise(usable(single))


def atomic_facts(sentences: Column | str, claims: Column | str, passages: Column | str) -> Column:
    """Facts of each sentence ``(atomic_fact_id, fact, source_sentence_*, citation_ids, cited_passages)`` in order.

    Claims join their sentence by number (the last entry of a repeated number counts), passages their
    citation by ``pid``; citations without a passage are dropped from ``cited_passages``.
    """
    s, c, p = (F.col(x) if isinstance(x, str) else x for x in (sentences, claims, passages))
    claims_of = lambda n: F.when(F.exists(c, lambda x: x["sentence_id"] == n), clean_list(F.try_element_at(F.filter(c, lambda x: x["sentence_id"] == n), F.lit(-1))["claims"])).otherwise(_none("string"))
    cited = lambda ids: F.filter(F.transform(ids, lambda n: F.try_element_at(F.filter(p, lambda x: x["pid"] == n), F.lit(-1))), lambda x: x.isNotNull())
    per_sentence = F.transform(
        s,
        lambda x: F.transform(
            claims_of(x["sentence_id"]),
            lambda fact, k: F.struct(
                F.concat(F.lit("s"), x["sentence_id"].cast("string"), F.lit("_a"), (k + 1).cast("string")).alias("atomic_fact_id"), fact.alias("fact"), x["sentence_id"].alias("source_sentence_id"),
                x["sentence_text"].alias("source_sentence_text"), x["raw_sentence"].alias("source_sentence_raw"), x["role"].alias("source_sentence_role"), x["citation_ids"].alias("citation_ids"), cited(x["citation_ids"]).alias("cited_passages"),
            ),
        ),
    )
    return F.flatten(per_sentence)


def claim_records(ok: DataFrame, model: str = "") -> DataFrame:
    """Output records of claims: the source row with its sentences' facts, nested and flat, their counts and the model's name."""
    own = [c for c in ok.schema["source"].dataType.fieldNames() if c not in _CLAIM_FIELDS]
    rows = ok.select("row_idx", "payload", "source.*") if "row_idx" not in own else ok.select("payload", "source.*")
    rows = rows.withColumn("_s", claim_sentences(rows)).withColumn("_p", citable_passages(rows))
    rows = rows.withColumn("atomic_facts_flat", atomic_facts("_s", "payload.sentences", "_p"))
    of = lambda n: F.filter("atomic_facts_flat", lambda f: f["source_sentence_id"] == n)
    nested = F.transform(
        "_s",
        lambda s: F.struct(
            s["sentence_id"].alias("sentence_id"), s["raw_sentence"].alias("raw_sentence"), s["sentence_text"].alias("sentence_text"),
            s["role"].alias("sentence_role"), s["citation_ids"].alias("citation_ids"), of(s["sentence_id"]).alias("atomic_facts"),
        ),
    )
    keep = own if "row_idx" in own else ["row_idx", *own]
    return rows.select(
        *(f"`{c}`" for c in keep), F.lit(model).alias("atomic_model"), nested.alias("sentence_atomic_decomposition"), "atomic_facts_flat",
        F.size("_s").alias("num_sentences_detected"), F.size("atomic_facts_flat").alias("num_atomic_facts"), F.lit("").alias("atomic_error"),
    )


_CLAIM_FIELDS = ("atomic_model", "sentence_atomic_decomposition", "atomic_facts_flat", "num_sentences_detected", "num_atomic_facts", "atomic_error")


def claim_sentences(rows: DataFrame) -> Column:
    """Cited sentences of answer records: of ``answer_sentences``, else of ``answer_text`` or ``answer``."""
    answer = first_text(*(c for c in ("answer_text", "answer") if c in rows.columns)) if {"answer_text", "answer"} & set(rows.columns) else F.lit("")
    have = _fields_of(rows, "answer_sentences")
    kinds = {"sentence_id": "string", "text": "string", "citations": "array<int>", "role": "string"}
    if not have:
        return sentences_for_claims(answer, F.lit(None).cast("array<struct<sentence_id:string,text:string,citations:array<int>,role:string>>"))
    return sentences_for_claims(answer, F.transform("answer_sentences", lambda x: F.struct(*((x[f] if f in have else F.lit(None)).cast(k).alias(f) for f, k in kinds.items()))))
