"""The dense daily per-repository mart.

Shape at scale
--------------
* The calendar is every repo x every day from the global first created day
  to ``as_of``. The date bounds are one row, read through a scalar subquery
  (evaluated once, inlined as a literal), and each repo row expands its own
  days with ``explode(sequence(..))``: no cross join, no shuffle.
* Open/stale backlog (R2): instead of joining every calendar day to every
  issue of the repo, each issue emits at most four +1/-1 events. Events are
  pre-aggregated per (repo, day) with the calendar rows and daily PR counts
  in ONE grouped shuffle, then a running sum per repo runs over the repo's
  calendar (bounded by the number of days, never by the number of issues),
  so a repo holding a third of all issues costs no more than any other.
* Facts may be plans over the raw tables, so the mart reads each of them once:
  their sums per (repo, day) are stored, and bounds, repos and the mart's rows
  are all taken from those.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repo_pulse.operators.lifecycle import DEFAULT_STALE_DAYS
from repo_pulse.operators.upsert import commit_version


def repo_list(fact_pr: DataFrame, fact_issue: DataFrame) -> DataFrame:
    """Distinct repos of both facts (a NULL repo is kept, as ``distinct`` does)."""
    return (fact_pr.select("repo_full_name").union(fact_issue.select("repo_full_name"))
            .distinct())


def date_bounds(fact_pr: DataFrame, fact_issue: DataFrame, as_of: dt.date) -> DataFrame:
    """One row (min_date, max_date): first created day of either fact, capped at ``as_of``."""
    days = (fact_pr.select(F.to_date("created_at").alias("d"))
            .union(fact_issue.select(F.to_date("created_at").alias("d"))))
    return _bounds(days, as_of)


def _bounds(days: DataFrame, as_of: dt.date) -> DataFrame:
    today = F.lit(as_of)
    return days.agg(F.least(F.coalesce(F.min("d"), today), today).alias("min_date"),
                    today.alias("max_date"))


def first_created(fact: DataFrame) -> DataFrame:
    """Earliest ``created_at`` of every repo of a fact, stored: ``repo_list`` and ``date_bounds`` give the same for it."""
    return commit_version(fact.groupBy("repo_full_name").agg(F.min("created_at").alias("created_at")), "first_created")


def _days(bounds: DataFrame) -> tuple[Column, Column]:
    """(first day, last day) of a bounds row, as scalar subqueries."""
    return bounds.select("min_date").scalar(), bounds.select("max_date").scalar()


def calendar(repos: DataFrame, bounds: DataFrame) -> DataFrame:
    """J3 + J4: (metric_date, repo) for every repo and every day in bounds."""
    return _calendar(repos, *_days(bounds))


def _calendar(repos: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Each repo row expands its own days; an empty range (lo > hi) yields none."""
    days = F.when(lo <= hi, F.sequence(lo, hi))
    return repos.select(F.explode(days).alias("metric_date"), "repo_full_name")


def pr_created_daily(fact_pr: DataFrame) -> DataFrame:
    """A2: PRs created per (day, repo) and their mean hours to first review."""
    return fact_pr.groupBy(F.to_date("created_at").alias("metric_date"), "repo_full_name").agg(
        F.count(F.lit(1)).alias("prs_created_count"),
        F.avg("time_to_first_review_hours").alias("avg_time_to_first_review_hours"))


def pr_merged_daily(fact_pr: DataFrame) -> DataFrame:
    """A3: PRs merged per (day, repo) and their mean hours to merge."""
    return (fact_pr.filter(F.col("merged_at").isNotNull())
            .groupBy(F.to_date("merged_at").alias("metric_date"), "repo_full_name").agg(
                F.count(F.lit(1)).alias("prs_merged_count"),
                F.avg("time_to_merge_hours").alias("avg_time_to_merge_hours")))


# Columns of the per-(repo, day) contribution rows, in union order.
_PARTS = ["repo_full_name", "metric_date", "is_cal", "n_created", "ttfr_sum", "ttfr_n",
          "n_merged", "ttm_sum", "ttm_n", "d_open", "d_stale"]


def _row(repo: Column, day: Column, **vals: Column) -> list[Column]:
    out = [repo.alias("repo_full_name"), day.alias("metric_date")]
    for c in _PARTS[2:]:
        out.append(vals.get(c, F.lit(0)).cast("bigint").alias(c))
    return out


def _calendar_rows(cal: DataFrame) -> DataFrame:
    return cal.select(*_row(F.col("repo_full_name"), F.col("metric_date"), is_cal=F.lit(1)))


def _entry(day: Column, **vals: Column) -> Column:
    return F.struct(day.alias("metric_date"), *[vals.get(c, F.lit(0)).cast("bigint").alias(c) for c in _PARTS[2:]])


def _pr_rows(fact_pr: DataFrame) -> DataFrame:
    """Contributions of every PR on its created and its merged day, in one scan."""
    ttfr, ttm, merged = F.col("time_to_first_review_hours"), F.col("time_to_merge_hours"), F.col("merged_at")
    entries = F.array(
        _entry(F.to_date("created_at"), n_created=F.lit(1),
               ttfr_sum=F.coalesce(ttfr, F.lit(0)), ttfr_n=ttfr.isNotNull()),
        F.when(merged.isNotNull(), _entry(F.to_date(merged), n_merged=F.lit(1),
                                          ttm_sum=F.coalesce(ttm, F.lit(0)), ttm_n=ttm.isNotNull())))
    return fact_pr.select("repo_full_name", F.inline(F.array_compact(entries)))


def issue_events(fact_issue: DataFrame, stale_days: int = DEFAULT_STALE_DAYS) -> DataFrame:
    """R2: per issue, at most four (day, d_open, d_stale) backlog changes.

    Open on day d:  created <= d < closed (or never closed).
    Stale on day d: open on d and d - updated_date > stale_days, i.e. from
    greatest(created, updated_date + stale_days + 1) until closed.
    """
    return _issue_days(fact_issue, stale_days).filter(F.col("n_facts") == 0).drop("n_facts")


def _issue_days(fact_issue: DataFrame, stale_days: int) -> DataFrame:
    """(repo, day, o, s, n_facts): the backlog changes, and one row with ``n_facts`` 1 on the created day (or NULL)."""
    c = F.to_date("created_at")
    x = F.to_date("closed_at")
    u = F.to_date("updated_at")
    g = F.greatest(c, F.date_add(u, stale_days + 1))  # u not NULL where used
    row = lambda day, o, s, n: F.struct(
        day.alias("day"), F.lit(o).alias("o"), F.lit(s).alias("s"), F.lit(n).alias("n_facts"))
    ev = lambda day, o, s, keep: F.when(c.isNotNull() & keep, row(day, o, s, 0))
    events = F.array(
        row(c, 0, 0, 1),
        ev(c, 1, 0, x.isNull() | (x > c)),
        ev(x, -1, 0, x > c),
        ev(g, 0, 1, u.isNotNull() & (x.isNull() | (x > g))),
        ev(x, 0, -1, u.isNotNull() & (x > g)),
    )
    return fact_issue.select("repo_full_name", F.inline(F.array_compact(events)))


def _issue_rows(fact_issue: DataFrame, stale_days: int) -> DataFrame:
    e = issue_events(fact_issue, stale_days)
    return e.select(*_row(F.col("repo_full_name"), F.col("day"), d_open=F.col("o"), d_stale=F.col("s")))


def day_sums(fact_pr: DataFrame, fact_issue: DataFrame, stale_days: int = DEFAULT_STALE_DAYS) -> DataFrame:
    """Contributions of both facts summed per (repo, day), in one scan of each.

    ``n_facts`` counts the fact rows created that day. NULL repos and days are
    kept, so every repo has a row with ``n_facts`` > 0, as has the first day.
    """
    e = _issue_days(fact_issue, stale_days)
    issues = e.select(*_row(F.col("repo_full_name"), F.col("day"), d_open=F.col("o"), d_stale=F.col("s")),
                      F.col("n_facts").cast("bigint").alias("n_facts"))
    rows = _pr_rows(fact_pr).withColumn("n_facts", F.col("n_created")).unionByName(issues)
    return rows.groupBy("repo_full_name", "metric_date").agg(*[F.sum(c).alias(c) for c in [*_PARTS[2:], "n_facts"]])


def _rollup(cal: DataFrame, lo: Column, hi: Column, parts: list[DataFrame]) -> DataFrame:
    """One grouped shuffle over calendar + contributions, then running backlog sums.

    Contributions with a NULL repo never match a calendar row (equi-join
    semantics), and days outside the calendar fall away, so both are
    filtered before the shuffle.
    """
    contrib = parts[0]
    for p in parts[1:]:
        contrib = contrib.unionByName(p)
    contrib = contrib.filter(F.col("repo_full_name").isNotNull()
                             & F.col("metric_date").between(lo, hi))
    rows = _calendar_rows(cal).unionByName(contrib)
    daily = (rows.groupBy("repo_full_name", "metric_date")
             .agg(*[F.sum(c).alias(c) for c in _PARTS[2:]])
             .filter(F.col("is_cal") > 0))
    w = (Window.partitionBy("repo_full_name").orderBy("metric_date")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (daily.withColumn("open_issues_count", F.sum("d_open").over(w))
                 .withColumn("stale_issues_count", F.sum("d_stale").over(w)))


def _avg(s: str, n: str) -> Column:
    return F.when(F.col(n) > 0, F.col(s).cast("double") / F.col(n))


def issue_backlog_daily(fact_issue: DataFrame, cal: DataFrame, bounds: DataFrame,
                        stale_days: int = DEFAULT_STALE_DAYS) -> DataFrame:
    """M7: open and stale issues per (day, repo) over the calendar."""
    out = _rollup(cal, *_days(bounds), [_issue_rows(fact_issue, stale_days)])
    return out.select("metric_date", "repo_full_name",
                      F.col("open_issues_count").cast("bigint").alias("open_issues_count"),
                      F.col("stale_issues_count").cast("bigint").alias("stale_issues_count"))


def mart_repo_health_daily(fact_pr: DataFrame, fact_issue: DataFrame, as_of: dt.date,
                           stale_days: int = DEFAULT_STALE_DAYS) -> DataFrame:
    """M8: calendar with PR throughput, latency and issue backlog; counts 0 when absent."""
    sums = commit_version(day_sums(fact_pr, fact_issue, stale_days), "mart_day_sums")
    created = sums.filter(F.col("n_facts") > 0)
    lo = _bounds(created.select(F.col("metric_date").alias("d")), as_of).select("min_date").scalar()
    hi = F.lit(as_of)
    cal = _calendar(created.select("repo_full_name").distinct(), lo, hi)
    out = _rollup(cal, lo, hi, [sums.select(*_PARTS)])
    return out.select(
        "metric_date", "repo_full_name",
        F.col("n_created").alias("prs_created_count"),
        F.col("n_merged").alias("prs_merged_count"),
        F.col("open_issues_count").cast("bigint").alias("open_issues_count"),
        F.col("stale_issues_count").cast("bigint").alias("stale_issues_count"),
        _avg("ttfr_sum", "ttfr_n").alias("avg_time_to_first_review_hours"),
        _avg("ttm_sum", "ttm_n").alias("avg_time_to_merge_hours"),
    )
