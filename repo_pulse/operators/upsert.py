"""Look-back filter, keyed upsert, schema sync, incremental recompute.

No table format (Delta/Iceberg/Hudi) is assumed, so MERGE is expressed as
``target ANTI JOIN source-keys UNION source`` and every result is written
to a NEW version directory; a path being read is never overwritten.

Incremental recompute picks the keys to refresh by ARRIVAL (the rows of the
new raw batch), not by event time, and recomputes each affected key from all
of its current inputs, so the result equals a full rebuild for any split of
the input.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repo_pulse.operators import lifecycle as lc
from repo_pulse.operators import staging as stg
from repo_pulse.operators.dedup import latest_version, version_order
from repo_pulse.session import PARQUET_OPTIONS, new_work_dir, shuffles_dropped

EPOCH = dt.datetime(1970, 1, 1)


class DuplicateKeyError(ValueError):
    """A merge source holds a key more than once (the warehouse refuses it too)."""


def lookback_cutoff(target: DataFrame, ts_col: str = "updated_at", days: int = 1):
    """Scalar ``max(target.ts) - days``; an empty target gives 1970-01-01."""
    cut = F.coalesce(F.timestamp_add("DAY", F.lit(-days), F.max(ts_col)), F.lit(EPOCH).cast("timestamp"))
    return target.agg(cut.alias("cutoff")).scalar()


def lookback_filter(source: DataFrame, target: DataFrame, ts_col: str = "updated_at", days: int = 1) -> DataFrame:
    """Source rows with ``ts >= max(target.ts) - days`` (NULL ts dropped)."""
    return source.filter(F.col(ts_col) >= lookback_cutoff(target, ts_col, days))


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once in a merge source, with their count."""
    return (source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def assert_unique_keys(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise before merging when the source has duplicate keys (one small job)."""
    bad = duplicate_keys(source, keys).limit(1).collect()
    if bad:
        raise DuplicateKeyError(f"merge source has duplicate key {bad[0].asDict()}")


def matching(df: DataFrame, keys_of: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose key is (``left_semi``) or is not (``left_anti``) in ``keys_of``; NULL equals NULL, as in a grouping."""
    other = keys_of.select(*[F.col(k).alias(f"_match_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_match_{k}"))
    return df.join(other, same, how)


def upsert_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  sync_schema: bool = True, check_keys: bool = True, source_keys: DataFrame | None = None) -> DataFrame:
    """I2 + I3 + I8: update-or-insert every source row; other target rows kept.

    A source that holds a key twice is refused (one aggregate over its keys)
    unless ``check_keys`` is off because the source is unique by construction.

    With ``sync_schema`` the result has exactly the source columns: columns
    new in the source appear (NULL for old rows), vanished ones are dropped.

    ``source_keys``: stored rows with exactly the keys of the source, which
    spare computing it again for the match.
    """
    if check_keys:
        assert_unique_keys(source, keys)
    kept = matching(target, source if source_keys is None else source_keys, keys, "left_anti")
    if sync_schema:
        return kept.unionByName(source, allowMissingColumns=True).select(*source.columns)
    return kept.unionByName(source)


def commit_version(df: DataFrame, table: str, partition_by: Sequence[str] | None = None,
                   cluster_by: Sequence[str] | None = None, at: str | None = None) -> DataFrame:
    """I9 + R4: write ``df`` as a new version of ``table`` and read it back.

    The version is the folder ``at/table`` (``at``: a folder of the run), by
    default a new one under the work folder.

    ``partition_by`` gives directory partitions (pruned on read);
    ``cluster_by`` sorts rows within each file so parquet min/max statistics
    skip row groups (the clustering of I7).
    """
    spark = df.sparkSession
    path = f"{at}/{table}" if at else new_work_dir(spark, f"table-{table}")
    out = rebalanced(df, partition_by)
    if cluster_by:
        out = out.sortWithinPartitions(*(list(partition_by or []) + list(cluster_by)))
    w = out.write.mode("overwrite").options(**PARQUET_OPTIONS)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_dropped(spark):
        w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # an empty partitioned table has no file to tell its schema


def rebalanced(df: DataFrame, partition_by: Sequence[str] | None) -> DataFrame:
    """Group rows of a directory partition into few tasks before a partitioned write.

    The REBALANCE hint lets AQE split a skewed partition value (a day holding
    a third of the rows) over several tasks and merge small ones, so the
    write makes few files per directory without one giant task.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], cluster_by: Sequence[str] = ()) -> None:
    """Dynamic partition overwrite: only partitions present in ``df`` are replaced."""
    out = rebalanced(df, partition_by).sortWithinPartitions(*partition_by, *cluster_by)
    with shuffles_dropped(df.sparkSession):
        (out.write.mode("overwrite").options(**PARQUET_OPTIONS).option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by).parquet(path))


# ---------------------------------------------------------------- incremental models

REVIEW_KEY = ["repo_full_name", "review_id"]


def first_versions(parsed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest version of every arrived key: the whole table where there was none before."""
    return latest_version(parsed.filter(F.col(keys[-1]).isNotNull()), keys, version_order())


def _arrived_versions(parsed: DataFrame, keys: Sequence[str], at: str | None) -> DataFrame:
    """Latest version of every arrived key, stored: the payloads are parsed once, whatever reads the rows afterwards."""
    return commit_version(first_versions(parsed, keys), f"arrived_versions_{keys[-1]}", at=at)


def review_versions_update(stg_target: DataFrame, new_raw: DataFrame, at: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Latest-version table of reviews after a new raw batch.

    ``stg_target`` holds one row per (repo, review_id) with the hidden
    ``_tie`` hash (before the pr_number filter). Returns the updated table
    and the (repo, pr_number) keys whose review set may have changed: the
    PR of the old version and of the newest arrived version of every arrived review.
    Both read the arrived rows, which are stored under ``at`` (by default in the work folder).
    """
    arrived = _arrived_versions(stg.parse_reviews(new_raw), REVIEW_KEY, at)
    updated, old = _versions_merged(stg_target, arrived, REVIEW_KEY)
    changed_prs = (old.select("repo_full_name", "pr_number")
                   .union(arrived.select("repo_full_name", "pr_number"))
                   .filter(F.col("pr_number").isNotNull()).distinct())
    return updated, changed_prs


def reviews_agg_of(reviews: DataFrame, prs: DataFrame) -> DataFrame:
    """A1 of the PRs ``prs`` from all reviews.

    The reviews are dealt out by PR either way, so they are counted first and
    the counts matched; where the keys are few enough to broadcast, Spark
    matches the reviews instead, before they are counted.
    """
    current = reviews.filter(F.col("pr_number").isNotNull())
    return matching(lc.reviews_agg(current), prs, PULL_KEY)


def reviews_agg_incremental(agg_target: DataFrame, stg_reviews_all: DataFrame,
                            changed_prs: DataFrame) -> DataFrame:
    """I4: recompute A1 for affected PRs from ALL their current reviews, then upsert.

    A PR whose last review moved away disappears (anti join removes it and
    the recompute yields nothing), as in a full rebuild.
    """
    keys = ["repo_full_name", "pr_number"]
    fresh = reviews_agg_of(stg_reviews_all, changed_prs)
    kept = matching(agg_target, changed_prs, keys, "left_anti")
    return kept.unionByName(fresh)


PULL_KEY = ["repo_full_name", "pr_number"]


ISSUE_KEY = ["repo_full_name", "issue_number"]


def _versions_update(stg_target: DataFrame, arrived: DataFrame, keys: Sequence[str], at: str | None) -> tuple[DataFrame, DataFrame]:
    """Latest-version table after the parsed rows ``arrived``, and the keys they touch."""
    arrived = _arrived_versions(arrived, keys, at)
    return _versions_merged(stg_target, arrived, keys)[0], arrived.select(*keys)


def _versions_merged(stg_target: DataFrame, arrived: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Latest-version table after ``arrived`` (stored, one row a key), and the target's rows of these keys."""
    old = matching(stg_target, arrived, keys)
    merged = latest_version(old.unionByName(arrived), keys, version_order())  # unique by construction
    return upsert_by_key(stg_target, merged, keys, sync_schema=False, check_keys=False, source_keys=arrived), old


def pull_versions_update(stg_target: DataFrame, new_raw: DataFrame, at: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Latest-version table of pulls after a new raw batch, and the arrived PR keys."""
    return _versions_update(stg_target, stg.parse_pulls(new_raw), PULL_KEY, at)


def issue_versions_update(stg_target: DataFrame, new_raw: DataFrame, at: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Latest-version table of issues after a new raw batch, and the arrived issue keys."""
    return _versions_update(stg_target, stg.parse_issues(new_raw), ISSUE_KEY, at)


def pr_lifecycle_incremental(life_target: DataFrame, stg_pulls_all: DataFrame, agg_all: DataFrame,
                             changed_pulls: DataFrame, changed_prs_by_reviews: DataFrame) -> DataFrame:
    """Refresh PRs that changed themselves OR whose reviews changed."""
    keys = changed_pulls.select(*PULL_KEY).union(changed_prs_by_reviews.select(*PULL_KEY)).distinct()
    return pr_lifecycle_merged(life_target, pr_lifecycle_of(stg_pulls_all, agg_all, keys), keys)


def pr_lifecycle_of(stg_pulls_all: DataFrame, agg_all: DataFrame, keys: DataFrame) -> DataFrame:
    """M4 of the PRs ``keys``, from their current rows."""
    return lc.pr_lifecycle(matching(stg_pulls_all, keys, PULL_KEY), matching(agg_all, keys, PULL_KEY), matched=True)


def pr_lifecycle_merged(life_target: DataFrame, fresh: DataFrame, keys: DataFrame) -> DataFrame:
    """The lifecycle with ``fresh`` as its rows of the PRs ``keys``."""
    return matching(life_target, keys, PULL_KEY, "left_anti").unionByName(fresh)


def fact_pr_incremental(fact_target: DataFrame, life_all: DataFrame, changed: DataFrame) -> DataFrame:
    """The PR fact after its lifecycle rows of the keys ``changed`` were refreshed."""
    fresh = lc.fact_pr_cycle_time(matching(life_all, changed, PULL_KEY))
    return matching(fact_target, changed, PULL_KEY, "left_anti").unionByName(fresh)


def issue_lifecycle_incremental(life_target: DataFrame, stg_issues_all: DataFrame, changed: DataFrame,
                                as_of: dt.date, stale_days: int = lc.DEFAULT_STALE_DAYS) -> DataFrame:
    """Refresh the issues that arrived; age and stale flag of all others follow ``as_of``.

    The day-dependent columns are functions of the row's own columns, so the
    rows that stay are re-aged by a projection, without a read of staging.
    """
    fresh = lc.issue_lifecycle(matching(stg_issues_all, changed, ISSUE_KEY), as_of, stale_days)
    kept = matching(life_target, changed, ISSUE_KEY, "left_anti")
    return lc.issue_lifecycle(kept, as_of, stale_days).unionByName(fresh)


def fact_issue_incremental(fact_target: DataFrame, life_all: DataFrame, changed: DataFrame,
                           as_of: dt.date, stale_days: int = lc.DEFAULT_STALE_DAYS) -> DataFrame:
    """The issue fact after its lifecycle rows of the keys ``changed`` were refreshed; others are re-aged."""
    fresh = lc.fact_issue_aging(matching(life_all, changed, ISSUE_KEY))
    kept = matching(fact_target, changed, ISSUE_KEY, "left_anti")
    return lc.fact_issue_aging(lc.issue_lifecycle(kept, as_of, stale_days)).unionByName(fresh)
