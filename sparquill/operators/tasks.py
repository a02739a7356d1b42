"""The four model tasks: prompts, output schemas, requests, and joining responses back to their rows.

A row's position (``row_idx``) is its identity: it is part of the request's custom id, and a response
joins its row on it.  Instructions are parameters; the defaults state what the output must hold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.functions.jsonio import parsed, request, response_text
from sparquill.functions.text import col, compact_list, has_text, let, norm_value, norm_ws, text, truncate
from sparquill.functions.values import number_after


@dataclass(frozen=True)
class Task:
    """One kind of model call: ``prefix`` of custom ids, output schemas, limits and instructions."""

    name: str
    prefix: str
    json_schema: str
    output: str
    max_output_tokens: int
    chunk: int
    instructions: str
    temperature: float | None = None


def _object(fields: str, names: list[str]) -> str:
    return '{"type":"object","additionalProperties":false,"required":[' + ",".join(f'"{n}"' for n in names) + '],"properties":{' + fields + "}}"


_TEXT, _TEXTS = '{"type":"string"}', '{"type":"array","items":{"type":"string"}}'

SEED = Task(
    "seed", "passage",
    _object(f'"passage_id":{_TEXT},"usable":{{"type":"boolean"}},"discard_reason":{_TEXT},"content_type":{_TEXT},"main_topic":{_TEXT},"semantic_summary":{_TEXT},"question_angles":{_TEXTS},"patient_language_keywords":{_TEXTS}',
            ["passage_id", "usable", "discard_reason", "content_type", "main_topic", "semantic_summary", "question_angles", "patient_language_keywords"]),
    "passage_id string, usable boolean, discard_reason string, content_type string, main_topic string, semantic_summary string, question_angles array<string>, patient_language_keywords array<string>",
    500, 100, "Annotate the passage: is it usable for questions of lay readers, its type, topic, a one-sentence summary, up to four question angles and up to eight plain keywords. Answer in the given JSON schema.",
)
QUESTION = Task(
    "question", "pool",
    _object(f'"pool_id":{_TEXT},"guideline_id":{_TEXT},"questions":{{"type":"array","items":' + _object(f'"question":{_TEXT},"question_type":{_TEXT},"perspective":{_TEXT},"patient_keywords":{_TEXTS},"retrieval_anchor_terms":{_TEXTS}', ["question", "question_type", "perspective", "patient_keywords", "retrieval_anchor_terms"]) + f'}},"skip_reason":{_TEXT}', ["pool_id", "guideline_id", "questions", "skip_reason"]),
    "pool_id string, guideline_id string, questions array<struct<question:string,question_type:string,perspective:string,patient_keywords:array<string>,retrieval_anchor_terms:array<string>>>, skip_reason string",
    900, 30, "Write at most one question a lay reader might ask that several of these passages answer, without mentioning them. Keep one to three concrete search terms in it. Answer in the given JSON schema.",
)
ANSWER = Task(
    "answer", "answer",
    _object(f'"answer_text":{_TEXT},"answer_sentences":{{"type":"array","items":' + _object(f'"text":{_TEXT},"citations":{{"type":"array","items":{{"type":"integer"}}}},"role":{_TEXT}', ["text", "citations", "role"]) + '},"evidence_gaps":{"type":"array","items":' + _object(f'"missing_issue":{_TEXT},"reason":{_TEXT}', ["missing_issue", "reason"]) + "}", ["answer_text", "answer_sentences", "evidence_gaps"]),
    "answer_text string, answer_sentences array<struct<text:string,citations:array<int>,role:string>>, evidence_gaps array<struct<missing_issue:string,reason:string>>",
    1600, 30, "Answer the question from the numbered passages alone; end every sentence with one to three citations like [1]. Say what the passages leave open. Answer in the given JSON schema.", 0.2,
)
CLAIMS = Task(
    "claims", "atomic",
    _object('"sentences":{"type":"array","items":' + _object(f'"sentence_id":{{"type":"integer"}},"claims":{_TEXTS}', ["sentence_id", "claims"]) + "}", ["sentences"]),
    "sentences array<struct<sentence_id:int,claims:array<string>>>",
    1600, 50, "Split each sentence into claims that each state one fact and stand alone. Keep all conditions. Answer in the given JSON schema.", 0.0,
)


def _lines(*pairs: tuple[str, Column]) -> Column:
    return F.concat_ws("\n", *(F.concat(F.lit(f"{k}: "), v) for k, v in pairs))


def seed_prompt() -> Column:
    """A passage with its source fields; null without an id or a text (the row is skipped)."""
    whole = F.concat_ws("\n", _lines(*((c, text(c)) for c in ("passage_id", "guideline_id", "section_title", "page_start", "page_end", "word_count", "reference_list_score"))), F.lit("\nPassage text:"), text("text"))
    return F.when(has_text("passage_id") & has_text("text"), whole)


def pool_prompt(max_source_chars: int = 1000, most: int = 30, first_only: bool = False, min_passages: int = 5) -> Column:
    """Pool hints and numbered passages (up to ``most``); null for pools without an id or with too few passages; ``first_only`` lists just the first one but states the full number."""
    given = F.slice(F.coalesce("passages", F.array()), 1, most)
    block = lambda p, i: F.concat_ws(
        "\n", F.concat(F.lit("["), (i + 1).cast("string"), F.lit("]")),
        _lines(("content_type", norm_ws(p["content_type"])), ("main_topic", norm_ws(p["main_topic"])), ("semantic_summary", norm_ws(p["semantic_summary"])), ("question_angles", compact_list(p["question_angles"])), ("patient_keywords", compact_list(p["patient_language_keywords"])), ("source_text", truncate(p["source_text"], max_source_chars))),
    )
    blocks = F.transform(F.slice(given, 1, 1) if first_only else given, block)
    head = _lines(
        ("pool_id", norm_ws("group_id")), ("guideline_id", norm_ws("guideline_id")), ("candidate_topic_hint", norm_ws("group_topic_hint")), ("candidate_summary_hint", norm_ws("group_summary_hint")),
        ("candidate_question_angles_hint", compact_list("group_question_angles_hint")), ("candidate_patient_keywords_hint", compact_list("group_patient_keywords_hint")), ("num_candidate_passages", F.size(given).cast("string")),
    )
    enough = (F.size(F.coalesce("passages", F.array())) >= max(1, min_passages)) & (F.length(norm_ws("group_id")) > 0)
    return F.when(enough, F.concat_ws("\n", head, F.lit("\nCandidate passages:"), F.array_join(blocks, "\n")))


def chosen_passages(top_n: int = 5, passages: Column | str = "retrieved_passages") -> Column:
    """The first ``top_n`` retrieved passages, those without text then dropped."""
    given = F.coalesce(col(passages), F.array())
    return F.filter(F.slice(given, 1, top_n), lambda p: has_text(p["text"]))


def context_block(passages: Column, max_chars: int = 1800) -> Column:
    """Numbered passages with their source fields, a blank line between them; fields that a passage lacks are empty, as is a score of zero."""

    def block(p: Column, i: Column) -> Column:
        names = ("passage_id", "guideline_id", "main_topic", "section", "rerank_score")
        own = F.to_variant_object(p.withField("text", F.lit("")))  # a variant for fields that may be missing; the text is not copied into it
        head = let(own, lambda v: _lines(*((name, norm_value(F.try_variant_get(v, f"$.{name}", "string"))) for name in names)))
        return F.concat_ws("\n", F.concat(F.lit("["), (i + 1).cast("string"), F.lit("]")), head, _lines(("text", truncate(p["text"], max_chars))))

    return F.array_join(F.transform(passages, block), "\n\n")


def answer_prompt(top_n: int = 5, max_chars: int = 1800, fields: tuple[str, ...] = ()) -> Column:
    """Question, the ``fields`` of the question that are asked for (lists as JSON), and the context block; null without question or passages."""
    chosen, question = chosen_passages(top_n), norm_ws("question")
    own = [F.concat(F.lit(f"{f}: "), F.coalesce(F.to_json(f), F.lit("[]")) if f in ("retrieval_anchor_terms", "patient_keywords") else norm_ws(f)) for f in fields]
    return F.when((F.length(question) > 0) & (F.size(chosen) > 0), F.concat_ws("\n", F.concat(F.lit("Question: "), question), *own, F.lit("\nPassages:"), context_block(chosen, max_chars)))


def claims_prompt(sentences: Column | str = "sentences") -> Column:
    """Numbered sentences with their citations; null without any (the row is skipped)."""
    s = F.col(sentences) if isinstance(sentences, str) else sentences
    line = lambda x: F.concat(F.lit("SENTENCE "), x["sentence_id"].cast("string"), F.lit("\nTEXT: "), x["sentence_text"], F.lit("\nCITATIONS: ["), F.array_join(F.transform(x["citation_ids"], lambda c: c.cast("string")), ", "), F.lit("]"))
    return F.when(F.size(s) > 0, F.concat(F.lit("Question: "), norm_ws("question"), F.lit("\n\n"), F.array_join(F.transform(s, line), "\n\n")))


def requests(rows: DataFrame, task: Task, user: Column, model: str, max_output_tokens: int | None = None, temperature: float | None = None) -> DataFrame:
    """``(row_idx, line)`` for rows whose prompt is not null."""
    custom = F.concat(F.lit(f"{task.prefix}-"), F.col("row_idx").cast("string"))
    line = request(custom, model, task.instructions, user, task.name, task.json_schema, max_output_tokens or task.max_output_tokens, task.temperature if temperature is None else temperature)
    return rows.select("row_idx", line.alias("line")).where("line IS NOT NULL")


def responses(lines: DataFrame, task: Task) -> DataFrame:
    """Result lines ``(line)`` to ``(custom_id, row_idx, raw_text, payload, error)``; one bad line spoils only itself."""
    parsed_line = F.try_parse_json("line")
    custom = F.try_variant_get(parsed_line, "$.custom_id", "string")
    rows = lines.select("line", custom.alias("custom_id"), response_text("line").alias("raw_text"), parsed_line.isNull().alias("broken"))
    rows = rows.withColumn("row_idx", number_after("custom_id", task.prefix)).withColumn("payload", parsed("raw_text", task.output))
    error = (
        F.when(F.col("broken"), "line is not JSON")
        .when(F.col("row_idx").isNull(), "bad custom_id")
        .when(F.col("raw_text").isNull(), "empty output")
        .when(F.col("payload").isNull(), "no JSON object")
    )
    return rows.select("custom_id", "row_idx", "raw_text", "payload", error.alias("error"))


def joined(found: DataFrame, source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(responses with their source row as ``source``, failed responses with a reason)."""
    src = source.select("row_idx", F.struct(*source.columns).alias("source"))
    every = found.join(src, "row_idx", "left").withColumn("error", F.coalesce("error", F.when(F.col("source").isNull(), "row out of range")))
    return every.where("error IS NULL").drop("error"), every.where("error IS NOT NULL").select("custom_id", "row_idx", "error", "raw_text")
