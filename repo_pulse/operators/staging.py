"""M1-M3: typed latest-version staging of pulls, issues and reviews.

Per entity: filter the event type (pushed to the scan), parse the payload
once (R5), apply safe casts, drop NULL keys (a filter on a partition key
commutes with the dedup), then keep the latest version per key (W1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repo_pulse.functions import (
    json_scalar,
    label_names_csv,
    parse_payload,
    safe_bigint,
    safe_bool,
    safe_timestamp,
)
from repo_pulse.operators.dedup import latest_version, version_order

# Payload paths read per entity (scalar leaves as STRING).
PULL_SCHEMA = (
    "number string, id string, node_id string, state string, title string, draft string, "
    "html_url string, base struct<ref: string>, head struct<ref: string>, "
    "user struct<login: string, id: string>, additions string, deletions string, "
    "changed_files string, comments string, review_comments string, commits string, "
    "created_at string, updated_at string, closed_at string, merged_at string"
)
ISSUE_SCHEMA = (
    "pull_request variant, number string, id string, node_id string, state string, "
    "title string, html_url string, user struct<login: string, id: string>, comments string, "
    "labels array<variant>, created_at string, updated_at string, closed_at string"
)
REVIEW_SCHEMA = (
    "pull_request_url string, id string, node_id string, state string, body string, "
    "html_url string, user struct<login: string, id: string>, submitted_at string, "
    "created_at string, updated_at string"
)
PR_URL_NUMBER = r"/pulls/(\d+)$"


def _parsed(raw: DataFrame, event_type: str, schema: str, extra: list[str] | None = None) -> DataFrame:
    cols = ["ingestion_date", "repo_full_name", *(extra or []), "payload"]
    # A generator's output is computed once: a filter on it is not pushed below, where it would parse again.
    return (raw.filter(F.col("event_type") == event_type)
               .select(*cols, F.explode(F.array(parse_payload(F.col("payload"), schema))).alias("j")))


def _s(path: str) -> Column:
    """String leaf with the object/array guard."""
    return json_scalar(F.col("j." + path.removeprefix("$.")), F.col("payload"), path)


def _tie() -> Column:
    return F.xxhash64("payload").alias("_tie")


def parse_pulls(raw: DataFrame) -> DataFrame:
    """Typed pull request versions (no dedup), plus the ``_tie`` hash."""
    j = lambda f: F.col("j." + f)  # noqa: E731  leaves cast to numbers need no guard
    return _parsed(raw, "pull", PULL_SCHEMA).select(
        "ingestion_date",
        "repo_full_name",
        safe_bigint(j("number")).alias("pr_number"),
        safe_bigint(j("id")).alias("pull_request_id"),
        _s("$.node_id").alias("pull_request_node_id"),
        F.lower(_s("$.state")).alias("pull_request_state"),
        _s("$.title").alias("pull_request_title"),
        safe_bool(j("draft")).alias("is_draft"),
        _s("$.html_url").alias("pull_request_url"),
        _s("$.base.ref").alias("base_branch"),
        _s("$.head.ref").alias("head_branch"),
        _s("$.user.login").alias("author_login"),
        safe_bigint(j("user.id")).alias("author_id"),
        safe_bigint(j("additions")).alias("additions_count"),
        safe_bigint(j("deletions")).alias("deletions_count"),
        safe_bigint(j("changed_files")).alias("changed_files_count"),
        safe_bigint(j("comments")).alias("comments_count"),
        safe_bigint(j("review_comments")).alias("review_comments_count"),
        safe_bigint(j("commits")).alias("commits_count"),
        safe_timestamp(j("created_at")).alias("created_at"),
        safe_timestamp(j("updated_at")).alias("updated_at"),
        safe_timestamp(j("closed_at")).alias("closed_at"),
        safe_timestamp(j("merged_at")).alias("merged_at"),
        _tie(),
    )


def split_issue_feed(raw: DataFrame) -> DataFrame:
    """Issue rows of the mixed feed: ``pull_request`` key absent (JSON null keeps a row out)."""
    return _parsed(raw, "issue", ISSUE_SCHEMA).filter(F.col("j.pull_request").isNull())


def parse_issues(raw: DataFrame) -> DataFrame:
    j = lambda f: F.col("j." + f)
    return split_issue_feed(raw).select(
        "ingestion_date",
        "repo_full_name",
        safe_bigint(j("number")).alias("issue_number"),
        safe_bigint(j("id")).alias("issue_id"),
        _s("$.node_id").alias("issue_node_id"),
        F.lower(_s("$.state")).alias("issue_state"),
        _s("$.title").alias("issue_title"),
        _s("$.html_url").alias("issue_url"),
        _s("$.user.login").alias("author_login"),
        safe_bigint(j("user.id")).alias("author_id"),
        safe_bigint(j("comments")).alias("comments_count"),
        F.coalesce(F.array_size(j("labels")), F.lit(0)).cast("bigint").alias("labels_count"),
        label_names_csv(j("labels")).alias("labels_csv"),
        safe_timestamp(j("created_at")).alias("created_at"),
        safe_timestamp(j("updated_at")).alias("updated_at"),
        safe_timestamp(j("closed_at")).alias("closed_at"),
        _tie(),
    )


def review_pr_number(pr_number_col: Column, url: Column) -> Column:
    """The column, else the number at the end of ``/pulls/<n>``."""
    return F.coalesce(pr_number_col.cast("bigint"),
                      safe_bigint(F.nullif(F.regexp_extract(url, PR_URL_NUMBER, 1), F.lit(""))))


def parse_reviews(raw: DataFrame) -> DataFrame:
    j = lambda f: F.col("j." + f)
    submitted = safe_timestamp(j("submitted_at"))
    created = safe_timestamp(j("created_at"))
    return _parsed(raw, "pr_review", REVIEW_SCHEMA, extra=["pr_number"]).select(
        "ingestion_date",
        "repo_full_name",
        review_pr_number(F.col("pr_number"), _s("$.pull_request_url")).alias("pr_number"),
        safe_bigint(j("id")).alias("review_id"),
        _s("$.node_id").alias("review_node_id"),
        F.upper(_s("$.state")).alias("review_state"),
        _s("$.body").alias("review_body"),
        _s("$.html_url").alias("review_url"),
        _s("$.user.login").alias("reviewer_login"),
        safe_bigint(j("user.id")).alias("reviewer_id"),
        submitted.alias("submitted_at"),
        created.alias("created_at"),
        F.coalesce(submitted, safe_timestamp(j("updated_at")), created).alias("updated_at"),
        _tie(),
    )


def stg_pulls(raw: DataFrame) -> DataFrame:
    p = parse_pulls(raw).filter(F.col("pr_number").isNotNull())
    return latest_version(p, ["repo_full_name", "pr_number"], version_order()).drop("_tie")


def stg_issues(raw: DataFrame) -> DataFrame:
    i = parse_issues(raw).filter(F.col("issue_number").isNotNull())
    return latest_version(i, ["repo_full_name", "issue_number"], version_order()).drop("_tie")


def stg_reviews(raw: DataFrame) -> DataFrame:
    # The pr_number filter is not on the dedup key, so it stays after the dedup.
    r = parse_reviews(raw).filter(F.col("review_id").isNotNull())
    return (latest_version(r, ["repo_full_name", "review_id"], version_order())
            .filter(F.col("pr_number").isNotNull()).drop("_tie"))
