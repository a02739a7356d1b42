"""The query registry of the engine's own operators: each with DuckDB SQL for the same rows.

Inputs that the fixtures lack (citations, references, JSON) are derived by one SQL text that both
engines run, so the oracle differs only in how it computes the answer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparquill.plans import answers, evidence, passages

_FAMILIES = (passages, evidence, answers)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q[0] for f in _FAMILIES for name, q in f.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q[1] for f in _FAMILIES for name, q in f.QUERIES.items() if q[1]}
