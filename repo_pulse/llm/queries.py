"""Registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from repo_pulse.llm import (
    op1_quality_rules,
    op2_mixing,
    op3_toxicity,
    op4_secrets,
    op5_simhash,
    op6_kneser_ney,
    op7_line_dedup,
    op8_neighbours,
    op9_packing,
    op10_language,
    op11_metric_join,
    op12_conversations,
    op13_manifest,
)
from repo_pulse.llm.common import table


def _on(op, *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: op(*[table(spark, sf_dir, t) for t in tables])


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": _on(op1_quality_rules.op1, "documents"),
        "op2_mixing": _on(op2_mixing.op2, "documents"),
        "op3_toxicity": _on(op3_toxicity.op3, "documents", "labels"),
        "op4_secrets": _on(op4_secrets.op4, "documents"),
        "op5_simhash": _on(op5_simhash.op5, "documents"),
        "op6_kneser_ney": _on(op6_kneser_ney.op6, "documents", "labels"),
        "op7_line_dedup": _on(op7_line_dedup.op7, "documents"),
        "op8_neighbours": _on(op8_neighbours.op8, "embeddings"),
        "op9_packing": _on(op9_packing.op9, "documents"),
        "op10_language": _on(op10_language.op10, "documents"),
        "op11_metric_join": _on(op11_metric_join.op11, "embeddings"),
        "op12_conversations": _on(op12_conversations.op12, "conversations"),
        "op13_manifest": _on(op13_manifest.op13, "documents"),
        "pipeline": _pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_mixing": op2_mixing.ORACLE, "op11_metric_join": op11_metric_join.ORACLE, "op13_manifest": op13_manifest.ORACLE}
