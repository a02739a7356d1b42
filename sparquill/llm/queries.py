"""Queries of this subpackage: name -> callable(spark, sf_dir), and DuckDB SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparquill.llm.decontam import OP10_SQL, op10_decontaminate
from sparquill.llm.embed_dedup import OP3_SQL, op3_embedding_near_dedup
from sparquill.llm.edit_counts import op4_edit_aware_counts
from sparquill.llm.packing import op1_pack_sum_of_squares
from sparquill.llm.pii import op7_personal_data
from sparquill.llm.quality import op5_quality_ordinal
from sparquill.llm.secrets import op8_secret_scan
from sparquill.llm.simhash import op9_simhash_near_dedup
from sparquill.llm.suffix_dedup import OP6_SQL, op6_suffix_array_dedup
from sparquill.llm.toxicity import op2_toxicity_neighbours


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_pack_sum_of_squares,
        op2_toxicity_neighbours,
        op3_embedding_near_dedup,
        op4_edit_aware_counts,
        op5_quality_ordinal,
        op6_suffix_array_dedup,
        op7_personal_data,
        op8_secret_scan,
        op9_simhash_near_dedup,
        op10_decontaminate,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op3_embedding_near_dedup": OP3_SQL, "op6_suffix_array_dedup": OP6_SQL, "op10_decontaminate": OP10_SQL}
