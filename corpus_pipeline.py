"""Corpus pipeline: quality classifier, line dedup, near-dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repo_pulse.llm import op2_mixing, op5_simhash, op6_kneser_ney, op7_line_dedup, op9_packing
from repo_pulse.llm.common import fresh, store, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity passes their language's threshold."""
    score, limit, kept = (fresh(docs, c) for c in ("_score", "_limit", "_kept"))
    trusted = op6_kneser_ney.trusted_ids(table(spark, sf_dir, "labels"))
    out = op6_kneser_ney.classify(docs, trusted, score=score, threshold=limit, kept=kept)
    return out.where(F.col(kept)).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that recur elsewhere; n_chars follows the text."""
    gone = fresh(docs, "_gone_lines")
    out = op7_line_dedup.line_dedup(docs, count=gone)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(gone) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return op5_simhash.one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return op2_mixing.mix(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return op9_packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_tokens", pack_tokens),
]

#: Perplexity, fingerprints and token ids are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
