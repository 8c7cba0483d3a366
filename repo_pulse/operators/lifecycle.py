"""A1, M4, M5: review aggregate and PR / issue lifecycle metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repo_pulse.functions import days_between, hours_between, strict_greatest

EPOCH = dt.datetime(1970, 1, 1)
PR_KEYS = ["repo_full_name", "pr_number"]
ISSUE_KEYS = ["repo_full_name", "issue_number"]
DEFAULT_STALE_DAYS = 30


def reviews_agg(reviews: DataFrame) -> DataFrame:
    """Per-PR review counts. Exact distinct count (multi-stage aggregate)."""
    st = F.col("review_state")
    return reviews.groupBy(*PR_KEYS).agg(
        F.min("submitted_at").alias("first_review_at"),
        F.count(F.lit(1)).alias("review_count"),
        F.count_if(st == "APPROVED").alias("approvals_count"),
        F.count_if(st == "CHANGES_REQUESTED").alias("changes_requested_count"),
        F.count_if(st == "COMMENTED").alias("commented_count"),
        F.count_distinct("reviewer_login").alias("unique_reviewer_count"),
        F.max("updated_at").alias("updated_at"),
    )


REVIEW_COUNTS = ["review_count", "approvals_count", "changes_requested_count",
                 "commented_count", "unique_reviewer_count"]


def pr_lifecycle(pulls: DataFrame, review_agg: DataFrame, matched: bool = False) -> DataFrame:
    """J1 + M4: pulls left join the review aggregate on (repo, pr_number).

    Both sides are keyed by (repo, pr_number); the planner picks broadcast
    for a small aggregate and sort-merge (AQE skew split) for a large one.

    ``matched``: both sides come from a null-safe match with keys, by which
    they lie together already; the same condition in null-safe form joins
    them there, without another shuffle.
    """
    p = pulls.alias("p")
    r = review_agg.alias("r")
    on = F.lit(True)
    for k in PR_KEYS:
        a, b = F.col(f"p.{k}"), F.col(f"r.{k}")
        on = on & ((a.eqNullSafe(b) & a.isNotNull()) if matched else (a == b))
    joined = p.join(r, on, "left")
    pc = lambda c: F.col("p." + c)
    rc = lambda c: F.col("r." + c)
    created = pc("created_at")
    return joined.select(
        pc("repo_full_name").alias("repo_full_name"),
        pc("pr_number").alias("pr_number"),
        pc("pull_request_id").alias("pull_request_id"),
        pc("pull_request_state").alias("pull_request_state"),
        pc("pull_request_title").alias("pull_request_title"),
        pc("author_login").alias("author_login"),
        pc("author_id").alias("author_id"),
        pc("is_draft").alias("is_draft"),
        pc("additions_count").alias("additions_count"),
        pc("deletions_count").alias("deletions_count"),
        pc("changed_files_count").alias("changed_files_count"),
        pc("comments_count").alias("comments_count"),
        pc("review_comments_count").alias("review_comments_count"),
        pc("commits_count").alias("commits_count"),
        created.alias("created_at"),
        pc("updated_at").alias("pr_updated_at"),
        pc("closed_at").alias("closed_at"),
        pc("merged_at").alias("merged_at"),
        rc("first_review_at").alias("first_review_at"),
        *[F.coalesce(rc(c), F.lit(0).cast("bigint")).alias(c) for c in REVIEW_COUNTS],
        hours_between(rc("first_review_at"), created).alias("time_to_first_review_hours"),
        hours_between(pc("merged_at"), created).alias("time_to_merge_hours"),
        F.when(pc("merged_at").isNull(), hours_between(pc("closed_at"), created)).alias("time_open_hours"),
        pc("merged_at").isNotNull().alias("is_merged"),
        strict_greatest(pc("updated_at"), F.coalesce(rc("updated_at"), F.lit(EPOCH))).alias("updated_at"),
    )


def issue_lifecycle(issues: DataFrame, as_of: dt.date, stale_days: int = DEFAULT_STALE_DAYS) -> DataFrame:
    """M5: close latency, age (to close, else to ``as_of``) and stale flag."""
    created, closed, updated = F.col("created_at"), F.col("closed_at"), F.col("updated_at")
    today = F.lit(as_of)
    age = (F.when(closed.isNotNull() & created.isNotNull(), days_between(F.to_date(closed), F.to_date(created)))
            .when(created.isNotNull(), days_between(today, F.to_date(created))))
    stale = F.coalesce((F.col("issue_state") == "open") & updated.isNotNull()
                       & (days_between(today, F.to_date(updated)) > stale_days), F.lit(False))
    return issues.select(
        "repo_full_name", "issue_number", "issue_id", "issue_node_id", "issue_state", "issue_title",
        "issue_url", "author_login", "author_id", "comments_count", "labels_count", "labels_csv",
        "created_at", "updated_at", "closed_at",
        hours_between(closed, created).alias("time_to_close_hours"),
        age.alias("issue_age_days"),
        stale.alias("is_stale"),
    )


def fact_pr_cycle_time(lifecycle: DataFrame) -> DataFrame:
    """M6: lifecycle projection + ``created_date``; ``pr_updated_at`` dropped."""
    return lifecycle.select(
        "repo_full_name", "pr_number", "pull_request_id", "pull_request_state", "pull_request_title",
        "author_login", "author_id", "is_draft", "additions_count", "deletions_count",
        "changed_files_count", "comments_count", "review_comments_count", "commits_count",
        "created_at", F.to_date("created_at").alias("created_date"), "updated_at", "closed_at",
        "merged_at", "first_review_at", *REVIEW_COUNTS, "time_to_first_review_hours",
        "time_to_merge_hours", "time_open_hours", "is_merged",
    )


def fact_issue_aging(lifecycle: DataFrame) -> DataFrame:
    """Lifecycle + created / updated / closed dates."""
    return lifecycle.select(
        "repo_full_name", "issue_number", "issue_id", "issue_node_id", "issue_state", "issue_title",
        "issue_url", "author_login", "author_id", "comments_count", "labels_count", "labels_csv",
        "created_at", F.to_date("created_at").alias("created_date"),
        "updated_at", F.to_date("updated_at").alias("updated_date"),
        "closed_at", F.to_date("closed_at").alias("closed_date"),
        "time_to_close_hours", "issue_age_days", "is_stale",
    )
