"""Q1-Q9: data-quality checks. Each returns failing rows or failing counts.

Column checks on one table run in a single pass (one aggregate with a
``count_if`` per check), never one job per column.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The checks declared on every model.
NOT_NULL = {
    "stg_pulls": ["repo_full_name", "pr_number", "pull_request_id", "pull_request_state", "created_at", "updated_at"],
    "stg_issues": ["repo_full_name", "issue_number", "issue_id", "issue_state", "created_at", "updated_at"],
    "stg_reviews": ["repo_full_name", "pr_number", "review_id", "review_state", "updated_at"],
    "int_pr_reviews_agg": ["repo_full_name", "pr_number", "updated_at"],
    "int_pr_lifecycle": ["repo_full_name", "pr_number", "pull_request_id", "updated_at"],
    "int_issue_lifecycle": ["repo_full_name", "issue_number", "issue_id", "updated_at"],
    "fact_pr_cycle_time": ["repo_full_name", "pr_number", "pull_request_id", "created_date"],
    "fact_issue_aging": ["repo_full_name", "issue_number", "issue_id", "created_date"],
    "mart_repo_health_daily": ["metric_date", "repo_full_name"],
}
ACCEPTED_VALUES = {
    ("stg_pulls", "pull_request_state"): ["open", "closed"],
    ("stg_issues", "issue_state"): ["open", "closed"],
    ("stg_reviews", "review_state"): ["APPROVED", "CHANGES_REQUESTED", "COMMENTED", "DISMISSED", "PENDING"],
}
UNIQUE_KEYS = {
    "stg_pulls": ["repo_full_name", "pr_number"],
    "stg_issues": ["repo_full_name", "issue_number"],
    "stg_reviews": ["repo_full_name", "review_id"],
    "int_pr_reviews_agg": ["repo_full_name", "pr_number"],
    "int_pr_lifecycle": ["repo_full_name", "pr_number"],
    "int_issue_lifecycle": ["repo_full_name", "issue_number"],
    "fact_pr_cycle_time": ["repo_full_name", "pr_number"],
    "fact_issue_aging": ["repo_full_name", "issue_number"],
    "mart_repo_health_daily": ["metric_date", "repo_full_name"],
}
_CYCLE = [
    "time_to_first_review_hours is null or time_to_first_review_hours >= 0",
    "time_to_merge_hours is null or time_to_merge_hours >= 0",
    "time_open_hours is null or time_open_hours >= 0",
]
_ISSUE = [
    "time_to_close_hours is null or time_to_close_hours >= 0",
    "issue_age_days is null or issue_age_days >= 0",
]
EXPRESSIONS = {
    "int_pr_reviews_agg": ["review_count >= 0 and approvals_count >= 0 and changes_requested_count >= 0 "
                           "and unique_reviewer_count >= 0"],
    "int_pr_lifecycle": _CYCLE,
    "int_issue_lifecycle": _ISSUE,
    "fact_pr_cycle_time": _CYCLE,
    "fact_issue_aging": _ISSUE,
    "mart_repo_health_daily": ["prs_created_count >= 0 and prs_merged_count >= 0 and open_issues_count >= 0 "
                               "and stale_issues_count >= 0"],
}


def _long(df: DataFrame, table: str, label: str, names: Sequence[str]) -> DataFrame:
    """Unpivot a one-row wide result into (table_name, <label>, failing_rows)."""
    pairs = ", ".join(f"'{n}', `c{i}`" for i, n in enumerate(names))
    return df.selectExpr(f"'{table}' AS table_name",
                         f"stack({len(names)}, {pairs}) AS ({label}, failing_rows)")


def not_null(df: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    """Q1: NULL count of every listed column, one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    return _long(wide, table, "column_name", cols)


def accepted_values(df: DataFrame, table: str, col: str, values: Sequence[str]) -> DataFrame:
    """Q2: rows whose value is outside the list (NULL passes)."""
    bad = F.count_if(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
    return df.agg(bad.alias("failing_rows")).select(
        F.lit(table).alias("table_name"), F.lit(col).alias("column_name"), "failing_rows")


def unique_combination(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Q3: number of key combinations that occur more than once."""
    dups = df.groupBy(*keys).count().filter(F.col("count") > 1)
    return dups.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(table).alias("table_name"), "failing_rows")


def expression_is_true(df: DataFrame, table: str, exprs: Sequence[str]) -> DataFrame:
    """Q4: rows where the expression is false (NULL passes), one pass per table."""
    wide = df.agg(*[F.count_if(~F.expr(e)).alias(f"c{i}") for i, e in enumerate(exprs)])
    return _long(wide, table, "expression", exprs)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def not_null_all(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union([not_null(tables[t], t, cols) for t, cols in NOT_NULL.items() if t in tables])


def accepted_values_all(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union([accepted_values(tables[t], t, c, v) for (t, c), v in ACCEPTED_VALUES.items() if t in tables])


def unique_all(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union([unique_combination(tables[t], t, k) for t, k in UNIQUE_KEYS.items() if t in tables])


def expressions_all(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union([expression_is_true(tables[t], t, e) for t, e in EXPRESSIONS.items() if t in tables])


def _issue_age_bad() -> Column:
    return (F.col("issue_age_days") < 0) | (F.col("time_to_close_hours") < 0)


def issue_age_negative(fact_issue: DataFrame) -> DataFrame:
    """Q5: issues with a negative age or close latency."""
    return fact_issue.filter(_issue_age_bad())


def _cycle_time_bad() -> Column:
    return (F.col("time_to_first_review_hours") < 0) | (F.col("time_to_merge_hours") < 0) | (F.col("time_open_hours") < 0)


def cycle_time_negative(fact_pr: DataFrame) -> DataFrame:
    """Q6: PRs with a negative review, merge or open time."""
    return fact_pr.filter(_cycle_time_bad())


def _pr_dates_bad(as_of: dt.datetime) -> Column:
    c = F.col("created_at")
    now = F.lit(as_of).cast("timestamp")
    return (c.isNull() | (c > now) | (F.col("updated_at") < c) | (F.col("closed_at") < c)
            | (F.col("merged_at") < c))


def pr_dates_invalid(fact_pr: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q7: created missing or in the future; updated/closed/merged before created."""
    return fact_pr.filter(F.coalesce(_pr_dates_bad(as_of), F.lit(False)))


def reviews_before_creation(reviews: DataFrame, pulls: DataFrame) -> DataFrame:
    """Reviews submitted before their PR was created (equi-join + residual)."""
    r = reviews.select("repo_full_name", "pr_number", "review_id", "submitted_at")
    p = pulls.select("repo_full_name", "pr_number", "created_at")
    return (r.join(p, ["repo_full_name", "pr_number"])
            .filter(F.col("submitted_at") < F.col("created_at"))
            .select("repo_full_name", "pr_number", "review_id", "submitted_at", "created_at"))


def row_conditions(table: str, as_of: dt.datetime) -> list[tuple[str, Column]]:
    """(check name, failing condition) of every row check of one table, singular tests of the facts included."""
    checks: list[tuple[str, Column]] = []
    for c in NOT_NULL.get(table, []):
        checks.append((f"not_null:{c}", F.col(c).isNull()))
    for (t, c), vals in ACCEPTED_VALUES.items():
        if t == table:
            checks.append((f"accepted_values:{c}", F.col(c).isNotNull() & ~F.col(c).isin(list(vals))))
    for e in EXPRESSIONS.get(table, []):
        checks.append((f"expression_is_true:{e}", ~F.expr(e)))
    if table == "fact_issue_aging":
        checks.append(("issue_age_non_negative", _issue_age_bad()))
    if table == "fact_pr_cycle_time":
        checks += [("pr_cycle_time_non_negative", _cycle_time_bad()), ("pr_dates_valid", _pr_dates_bad(as_of))]
    return checks


def _table_checks(df: DataFrame, table: str, as_of: dt.datetime) -> DataFrame:
    """All declared checks of one table.

    Row conditions are one global aggregate: a task sends one row. Only the
    uniqueness check shuffles, and only the key columns. Output rows:
    (check_name, table_name, failing_rows).
    """
    checks = row_conditions(table, as_of)
    wide = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, (_, cond) in enumerate(checks)])
    pairs = ", ".join("'" + n.replace("'", "''") + f"', `c{i}`" for i, (n, _) in enumerate(checks))
    out = wide.selectExpr(f"stack({len(checks)}, {pairs}) AS (check_name, failing_rows)", f"'{table}' AS table_name")
    unique = unique_combination(df, table, UNIQUE_KEYS[table]).withColumn("check_name", F.lit("unique_combination"))
    return out.unionByName(unique)


def report(tables: Mapping[str, DataFrame], as_of: dt.datetime) -> DataFrame:
    """Q9: every check as (check_name, table_name, failing_rows).

    Each table costs one aggregate over its rows, which the singular tests of
    the facts share, and one count of its keys; the fourth test is a join.
    """
    parts = [_table_checks(df, t, as_of) for t, df in tables.items() if t in UNIQUE_KEYS]
    late = reviews_before_creation(tables["stg_reviews"], tables["stg_pulls"])
    parts.append(late.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit("review_after_pr_creation").alias("check_name"), F.lit("stg_reviews").alias("table_name"), "failing_rows"))
    return _union([p.select("check_name", "table_name", F.col("failing_rows").cast("bigint")) for p in parts])
