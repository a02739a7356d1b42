"""Model requests and responses: JSON building, text extraction and tolerant parsing as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparquill.functions.text import col, strip, text

#: The parts of a batch result line that are read.
RESPONSE = (
    "custom_id string, error string, response struct<status_code: int, body: struct<output_text: string, output: array<struct<type: string, content: array<struct<type: string, text: string>>>>>>"
)


def response_text(line: Column | str) -> Column:
    """Output text of a batch result line: the convenience field, else all text parts joined; null if there is none."""
    body = F.from_json(col(line), RESPONSE)["response"]["body"]
    parts = F.flatten(F.transform(body["output"], lambda o: F.coalesce(o["content"], F.array().cast("array<struct<type:string,text:string>>"))))
    texts = F.transform(F.filter(parts, lambda p: p["type"].isin("output_text", "text") & (F.length(p["text"]) > 0)), lambda p: p["text"])
    joined = strip(F.array_join(F.coalesce(texts, F.array().cast("array<string>")), "\n"))
    whole = strip(text(body["output_text"]))
    return F.when(F.length(whole) > 0, whole).when(F.length(joined) > 0, joined)


def json_object(raw: Column | str) -> Column:
    """The JSON object in a model's output as a string: all of it, or from the first to the last brace; null if neither parses."""
    s = strip(text(raw))
    inner = F.regexp_extract(s, r"(?s)\{.*\}", 0)
    is_object = lambda x: F.try_parse_json(x).isNotNull() & x.startswith("{")
    return F.when(is_object(s), s).when((F.length(inner) > 0) & is_object(inner), inner)


def parsed(raw: Column | str, schema: str) -> Column:
    """A struct from a model's output, null if there is no JSON object in it."""
    return F.from_json(json_object(raw), schema)


def compact(c: Column | str) -> Column:
    return F.to_json(col(c))


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def request(custom_id: Column, model: str, system: str, user: Column, schema_name: str, schema: str, max_output_tokens: int, temperature: float | None = None) -> Column:
    """A batch request line as JSON; a null user text gives null (the row is skipped).  Negative temperatures are left out."""
    body = [
        F.lit(model).alias("model"),
        F.array(message("system", F.lit(system)), message("user", user)).alias("input"),
        F.lit(int(max_output_tokens)).alias("max_output_tokens"),
    ]
    if temperature is not None and temperature >= 0:
        body.append(F.lit(float(temperature)).alias("temperature"))
    envelope = F.to_json(F.struct(custom_id.alias("custom_id"), F.lit("POST").alias("method"), F.lit("/v1/responses").alias("url"), F.struct(*body).alias("body")))
    # The output schema is JSON already, so it is put in before the closing braces.
    form = f'{{"format":{{"type":"json_schema","name":"{schema_name}","strict":true,"schema":{schema}}}}}'
    return F.when(user.isNotNull(), F.concat(F.regexp_replace(envelope, r"\}\}$", ""), F.lit(',"text":' + form + "}}")))
