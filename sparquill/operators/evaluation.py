"""Claim verification and support rates per claim, answer and data set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.functions.text import strip, text
from sparquill.functions.values import rate


def cited_passages(fact: Column, item_passages: Column) -> Column:
    """The fact's own cited passages, else the item's by ``pid`` in citation order (the last of a repeated pid counts)."""
    by_pid = F.filter(
        F.transform(F.coalesce(fact["citation_ids"], F.array().cast("array<int>")), lambda n: F.try_element_at(F.filter(item_passages, lambda p: p["pid"] == n), F.lit(-1))),
        lambda p: p.isNotNull(),
    )
    return F.when(F.size(F.coalesce(fact["cited_passages"], F.array())) > 0, fact["cited_passages"]).otherwise(by_pid)


def premise(p: Column) -> Column:
    """One passage as evidence text."""
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Passage "), text(p["pid"])),
        *(F.concat(F.lit(f"{f}: "), text(p[f])) for f in ("passage_id", "guideline_id", "main_topic", "section")),
        text(p["text"]),
    )


def joint_premise(passages: Column) -> Column:
    return F.array_join(F.transform(passages, premise), "\n\n")


def claims(items: DataFrame) -> DataFrame:
    """``items(item_id, question_type, atomic_facts_flat, passages)`` to one row per fact with its evidence and filter reason."""
    rows = items.select("item_id", "question_type", "passages", F.posexplode("atomic_facts_flat").alias("ordinal", "f"))
    rows = rows.withColumn("claim", strip(text(F.col("f.fact")))).withColumn("cited", cited_passages(F.col("f"), F.coalesce("passages", F.array())))
    reason = F.when(F.length("claim") == 0, "empty_claim").when(F.size("cited") == 0, "no_cited_passage").otherwise("kept")
    return rows.select(
        "item_id", "question_type", "ordinal", F.col("f.atomic_fact_id").alias("atomic_fact_id"), "claim", F.col("f.source_sentence_id").alias("source_sentence_id"),
        F.col("f.source_sentence_role").alias("source_sentence_role"), F.coalesce("f.citation_ids", F.array().cast("array<int>")).alias("citation_ids"), F.size("cited").alias("num_cited_passages"),
        (reason == "kept").alias("filter_keep"), reason.alias("filter_reason"), F.when(reason == "kept", joint_premise(F.col("cited"))).alias("premise"), "cited",
    )


def verified(claim_rows: DataFrame, model) -> DataFrame:
    """Adds ``joint_entailment`` and ``joint_raw_output``: each distinct (premise, claim) is asked once."""
    pairs = claim_rows.where("filter_keep").select("premise", "claim").distinct()
    verdicts = model.with_verdict(pairs, "premise", "claim")
    return claim_rows.join(verdicts, ["premise", "claim"], "left")


def individually(claim_rows: DataFrame, model) -> DataFrame:
    """Verdict per cited passage: ``(item_id, ordinal, pid, passage_id, entailment, raw_output)``."""
    each = claim_rows.where("filter_keep").select("item_id", "ordinal", "claim", F.explode("cited").alias("p")).withColumn("premise", premise(F.col("p")))
    verdicts = model.with_verdict(each.select("premise", "claim").distinct(), "premise", "claim")
    return each.join(verdicts, ["premise", "claim"], "left").select("item_id", "ordinal", "p.pid", "p.passage_id", F.col("joint_entailment").alias("entailment"), F.col("joint_raw_output").alias("raw_output"))


def _counts() -> list[Column]:
    keep, verdict = F.col("filter_keep"), F.col("joint_entailment")
    return [
        F.count("atomic_fact_id").alias("num_raw"),
        F.count_if(keep).alias("num_evaluated"),
        F.count_if(keep & (verdict == 1)).alias("num_supported"),
        F.count_if(keep & (verdict == 0)).alias("num_unsupported"),
        F.count_if(~keep).alias("num_skipped"),
    ]


def per_item(items: DataFrame, claim_rows: DataFrame) -> DataFrame:
    """One row per item (items without facts too) with counts and the support rate (null if nothing was evaluated)."""
    counted = claim_rows.groupBy("item_id").agg(*_counts())
    names = ["num_raw", "num_evaluated", "num_supported", "num_unsupported", "num_skipped"]
    rows = items.select("item_id", "question_type").join(counted, "item_id", "left").fillna(0, names)
    return rows.withColumn("support_rate", rate("num_supported", "num_evaluated"))


def by_key(claim_rows: DataFrame, key: str, *within: str) -> DataFrame:
    """Counts and support rate per value of ``key`` (null as empty), optionally within other columns."""
    return claim_rows.withColumn(key, text(key)).groupBy(*within, key).agg(*_counts()).withColumn("support_rate", rate("num_supported", "num_evaluated"))


def as_maps(keyed: DataFrame, key: str, *within: str) -> DataFrame:
    """Maps of raw, evaluated and supported counts and of rates; zero counts and rates of nothing are left out."""
    entry = lambda v: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.coalesce(F.col(v), F.lit(0)) != 0, F.struct(key, v)))))
    rates = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("num_evaluated") > 0, F.struct(key, "support_rate")))))
    return keyed.groupBy(*within).agg(entry("num_raw").alias("counts_raw"), entry("num_evaluated").alias("counts_evaluated"), entry("num_supported").alias("counts_supported"), rates.alias("support_rates"))


def skipped_reasons(claim_rows: DataFrame, *within: str) -> DataFrame:
    return claim_rows.where(~F.col("filter_keep")).groupBy(*within, "filter_reason").agg(F.count("*").alias("n"))


def summary(item_rows: DataFrame) -> DataFrame:
    """One row: totals, micro rate (supported of evaluated claims), macro rate (mean of item rates) and threshold counts."""
    r = F.col("support_rate")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return item_rows.agg(
        F.count("*").alias("num_items"),
        *(total(f"num_{c}").alias(f"num_claims_{c}") for c in ("raw", "evaluated", "supported", "unsupported", "skipped")),
        rate(F.sum("num_supported"), F.sum("num_evaluated")).alias("micro_rate"),
        F.avg(r).alias("macro_rate"),
        F.count_if(r.isNull()).alias("num_items_without_evaluated"),
        F.count_if(r > 0.8).alias("num_items_gt_0_8"),
        F.count_if(r >= 0.8).alias("num_items_ge_0_8"),
        F.count_if(r == 1.0).alias("num_items_eq_1"),
    )


def rollup(claim_rows: DataFrame) -> DataFrame:
    """Counts by (item, role), role, question type and over all in one pass of grouping sets."""
    roles = claim_rows.withColumn("role", text("source_sentence_role")).withColumn("question_type", text("question_type"))
    spec = [F.col("item_id"), F.col("role"), F.col("question_type")]
    return roles.groupingSets([[spec[0], spec[1]], [spec[1]], [spec[2]], []], *spec).agg(*_counts(), F.grouping_id().alias("level"))


def augmented(items: DataFrame, claim_rows: DataFrame) -> DataFrame:
    """Items with their facts and verdicts in order; of repeated fact ids the last verdict counts."""
    last = claim_rows.groupBy("item_id", "atomic_fact_id").agg(F.max_by(F.struct("filter_keep", "filter_reason", "joint_entailment", "joint_raw_output"), "ordinal").alias("v"))
    rows = claim_rows.select("item_id", "atomic_fact_id", "ordinal", "claim").join(last, ["item_id", "atomic_fact_id"])
    lists = rows.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", "atomic_fact_id", "claim", F.col("v").alias("evaluation")))).alias("evaluated_facts"))
    return items.join(lists, "item_id", "left")
