"""Change feeds against per-repo cursors, watermarks, gate, freshness.

The cursor table has one row per (entity, repo), so it is small next to any
feed; all repos are handled in one join instead of one query per repo.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fallback look-back for a repo without a cursor, freshness limits.
FALLBACK_DAYS = 7
WARN_AFTER_HOURS = 24
ERROR_AFTER_HOURS = 48
CURSOR_KEYS = ["entity", "repo_full_name"]


def cursor_lookup(cursors: DataFrame, entity: str, repos: DataFrame, now: dt.datetime,
                  fallback_days: int = FALLBACK_DAYS) -> DataFrame:
    """(entity, repo, since_ts); no row or NULL -> now - fallback_days."""
    c = cursors.filter(F.col("entity") == entity).select("repo_full_name", "last_updated_at")
    fallback = F.lit(now - dt.timedelta(days=fallback_days)).cast("timestamp")
    return (repos.select("repo_full_name").distinct()
            .join(c, "repo_full_name", "left")
            .select(F.lit(entity).alias("entity"), "repo_full_name",
                    F.coalesce(F.col("last_updated_at"), fallback).alias("since_ts")))


def changed_since_cursor(feed: DataFrame, since: DataFrame) -> DataFrame:
    """Feed rows with ``updated_at >= since`` of their repo; NULL updated_at dropped."""
    s = since.select("repo_full_name", "since_ts")
    return (feed.join(s, "repo_full_name")
            .filter(F.col("updated_at") >= F.col("since_ts"))
            .drop("since_ts"))


def changed_feed(feed: DataFrame, cursors: DataFrame, entity: str, now: dt.datetime, first_run: str = "full",
                 fallback_days: int = FALLBACK_DAYS) -> DataFrame:
    """S7 + S8 + S12 in one scan of the feed: rows at or after their repo's cursor.

    The cursor table (one row per entity and repo) is the small side of a left
    join, so Spark can broadcast it by its own size and the feed is not
    shuffled. Repos without a cursor: ``first_run="full"`` keeps every row,
    NULL ``updated_at`` included; ``"lookback"`` keeps the last ``fallback_days``.
    """
    if first_run not in ("full", "lookback"):
        raise ValueError(f"first_run must be 'full' or 'lookback', not {first_run!r}")
    c = (cursors.filter(F.col("entity") == entity)
         .select(F.col("repo_full_name").alias("_repo"), F.col("last_updated_at").alias("_since")))
    joined = feed.join(c, F.col("repo_full_name") == F.col("_repo"), "left")
    if first_run == "full":
        keep = F.col("_since").isNull() | (F.col("updated_at") >= F.col("_since"))
    else:
        keep = (F.col("updated_at") >= F.coalesce("_since", F.lit(now - dt.timedelta(days=fallback_days)).cast("timestamp"))) & F.col("repo_full_name").isNotNull()
    return joined.filter(keep).drop("_repo", "_since")


def reviews_of_changed_prs(reviews: DataFrame, changed_prs: DataFrame) -> DataFrame:
    """Every review of each changed PR (semi join on repo + number)."""
    keys = changed_prs.select("repo_full_name", "pr_number")
    return reviews.join(keys, ["repo_full_name", "pr_number"], "left_semi")


def watermark_max(changed: DataFrame, entity: str, ts_col: str = "updated_at") -> DataFrame:
    """New high-water mark per repo (max of the changed rows)."""
    return (changed.groupBy("repo_full_name")
            .agg(F.max(ts_col).alias("max_updated_at"))
            .select(F.lit(entity).alias("entity"), "repo_full_name", "max_updated_at"))


def cursor_upsert(cursors: DataFrame, watermarks: DataFrame, now: dt.datetime) -> DataFrame:
    """S13 + S14: MERGE on (entity, repo); only repos with a maximum advance.

    Matched rows get new ``last_updated_at``, ``last_success_run = updated_at = now``;
    unmatched ones are inserted; all others are kept as they are.
    """
    ts_now = F.lit(now).cast("timestamp")
    new = (watermarks.filter(F.col("max_updated_at").isNotNull())
           .select("entity", "repo_full_name",
                   F.col("max_updated_at").cast("timestamp").alias("last_updated_at"),
                   ts_now.alias("last_success_run"), ts_now.alias("updated_at")))
    kept = cursors.join(new.select(*CURSOR_KEYS), CURSOR_KEYS, "left_anti")
    return kept.select(*new.columns).unionByName(new)


def new_data_gate(cursors: DataFrame, entities: Sequence[str], run_start: dt.datetime,
                  repos: Sequence[str] | None = None) -> DataFrame:
    """One row ``updated_cursor_count``; an empty or missing repo list means all repos."""
    cond = F.col("entity").isin(list(entities)) & (F.col("updated_at") >= F.lit(run_start).cast("timestamp"))
    if repos:
        cond = cond & F.col("repo_full_name").isin(list(repos))
    return cursors.filter(cond).agg(F.count(F.lit(1)).alias("updated_cursor_count"))


def freshness_status(age_seconds: Column, warn_hours: int = WARN_AFTER_HOURS,
                     error_hours: int = ERROR_AFTER_HOURS) -> Column:
    return (F.when(age_seconds > error_hours * 3600, F.lit("error"))
             .when(age_seconds > warn_hours * 3600, F.lit("warn"))
             .otherwise(F.lit("pass")))


def newest_loads(sources: dict[str, DataFrame]) -> DataFrame:
    """(source_name, max_loaded_at): one aggregate per source; DATE counts as midnight."""
    parts = [df.agg(F.max(F.col("ingestion_date").cast("timestamp")).alias("max_loaded_at"))
               .select(F.lit(name).alias("source_name"), "max_loaded_at")
             for name, df in sources.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def freshness(loads: DataFrame, now: Column | dt.datetime, *keep: str) -> DataFrame:
    """Age of each newest load at ``now`` and its status; ``keep`` names further columns to carry."""
    now_c = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now_c)
    return loads.select(*keep, "source_name", "max_loaded_at",
                      (age / F.lit(3600.0)).alias("age_hours"),
                      freshness_status(age).alias("status"))


def source_freshness(sources: dict[str, DataFrame], now: Column | dt.datetime) -> DataFrame:
    """S17 for raw sources: one scan of one column each."""
    return freshness(newest_loads(sources), now)
