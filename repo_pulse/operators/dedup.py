"""Latest version of each entity key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_version(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key group under ``order``.

    ``row_number() = 1`` lets Catalyst plan a partial ``WindowGroupLimit``
    before the shuffle, so each map task forwards at most one row per key:
    a key with millions of re-deliveries costs one row per map partition.
    Order must be total; callers append a payload hash as the last key.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def version_order(updated_at: str = "updated_at", ingestion_date: str = "ingestion_date",
                  tie: str = "_tie") -> list[Column]:
    """Newest ``updated_at`` (NULLs last), then newest load, then payload hash."""
    return [F.col(updated_at).desc_nulls_last(), F.col(ingestion_date).desc_nulls_last(),
            F.col(tie).desc_nulls_last()]
