"""Dashboard queries over the daily mart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def pr_series(mart: DataFrame) -> DataFrame:
    """PRs created and merged per day over all repos."""
    return mart.groupBy("metric_date").agg(
        F.sum("prs_created_count").alias("prs_created_count"),
        F.sum("prs_merged_count").alias("prs_merged_count"))


def issue_series(mart: DataFrame) -> DataFrame:
    """Open and stale issues per day over all repos."""
    return mart.groupBy("metric_date").agg(
        F.sum("open_issues_count").alias("open_issues_count"),
        F.sum("stale_issues_count").alias("stale_issues_count"))


def scorecards(mart: DataFrame) -> DataFrame:
    """D3: unweighted mean over repo-days of the two daily averages (NULL skipped)."""
    return mart.agg(
        F.avg("avg_time_to_first_review_hours").alias("avg_time_to_first_review_hours"),
        F.avg("avg_time_to_merge_hours").alias("avg_time_to_merge_hours"))


def top_stale_repos(mart: DataFrame, k: int | None = None) -> DataFrame:
    """All repos (or the first ``k``) by stale issue count on the last day; name breaks ties."""
    last = mart.agg(F.max("metric_date")).scalar()
    ranked = (mart.filter(F.col("metric_date") == last)
              .orderBy(F.col("stale_issues_count").desc(), F.col("repo_full_name").asc()))
    return ((ranked if k is None else ranked.limit(k))
            .select("repo_full_name", "metric_date", "stale_issues_count", "open_issues_count"))


def filtered(mart: DataFrame, start: dt.date, end: dt.date, repos: Sequence[str] | None = None) -> DataFrame:
    """Date-range and repo controls (pushed down as plain predicates)."""
    cond = F.col("metric_date").between(F.lit(start), F.lit(end))
    if repos:
        cond = cond & F.col("repo_full_name").isin(list(repos))
    return mart.filter(cond)
