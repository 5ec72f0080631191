"""Queries of the corpus operators and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablesift.llm import decontaminate, jaccard_join, line_dedup, lm_score, packing, suffix_dedup, token_counts, topk, toxicity, url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": decontaminate.op1_decontamination,
        "op2_token_counts": token_counts.op2_token_counts,
        "op3_jaccard_join": jaccard_join.op3_jaccard_join,
        "op4_url_filter": url_filter.op4_url_filter,
        "op5_packing": packing.op5_packing,
        "op6_line_dedup": line_dedup.op6_line_dedup,
        "op7_lm_score": lm_score.op7_lm_score,
        "op8_topk": topk.op8_topk,
        "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
        "op10_toxicity": toxicity.op10_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": decontaminate.ORACLE, "op4_url_filter": url_filter.ORACLE, "op6_line_dedup": line_dedup.ORACLE, "op8_topk": topk.ORACLE}
