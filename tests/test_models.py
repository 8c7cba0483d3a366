"""Model semantics on small literal inputs, and the backlog rewrite against brute force."""

import datetime as dt
import json
import random

from repo_pulse.operators import lifecycle as lc
from repo_pulse.operators import mart
from repo_pulse.operators import quality as dq
from repo_pulse.operators import staging as stg

AS_OF = dt.date(2024, 3, 1)


def _raw(spark, event_type, docs):
    rows = [(dt.date.fromisoformat(d), repo, event_type, json.dumps(p)) for d, repo, p in docs]
    return spark.createDataFrame(rows, "ingestion_date date, repo_full_name string, event_type string, payload string")


def test_latest_version_nulls_last_then_newest_load(spark):
    raw = _raw(spark, "pull", [
        ("2024-01-01", "o/r", {"number": 1, "state": "OPEN", "updated_at": "2024-01-01T00:00:00Z"}),
        ("2024-01-03", "o/r", {"number": 1, "state": "closed", "updated_at": None}),
        ("2024-01-02", "o/r", {"number": 2, "state": "open", "updated_at": "2024-01-05T00:00:00Z"}),
        ("2024-01-04", "o/r", {"number": 2, "state": "closed", "updated_at": "2024-01-05T00:00:00Z"}),
        ("2024-01-04", "o/r", {"number": None, "state": "open"}),
        ("2024-01-04", "o/r", {"number": 3, "state": "open"}),
    ])
    got = {r.pr_number: r.pull_request_state for r in stg.stg_pulls(raw).collect()}
    assert got == {1: "open", 2: "closed", 3: "open"}


def test_issue_feed_drops_pull_requests(spark):
    raw = _raw(spark, "issue", [
        ("2024-01-01", "o/r", {"number": 1, "pull_request": {"url": "u"}}),
        ("2024-01-01", "o/r", {"number": 2, "pull_request": None}),
        ("2024-01-01", "o/r", {"number": 3, "labels": [{"name": "a"}]}),
    ])
    got = [(r.issue_number, r.labels_count, r.labels_csv) for r in stg.stg_issues(raw).collect()]
    assert got == [(3, 1, "a")]


def test_lifecycle_edges_and_quality(spark):
    pulls = _raw(spark, "pull", [
        ("2024-01-01", "o/r", {"number": 1, "id": 10, "state": "closed", "created_at": "2024-01-02T00:00:00Z",
                               "updated_at": "2024-01-02T00:00:00Z", "merged_at": "2024-01-01T00:00:00Z",
                               "closed_at": "2024-01-01T00:00:00Z"}),
        ("2024-01-01", "o/r", {"number": 2, "id": 20, "state": "open", "created_at": None, "updated_at": None}),
    ])
    reviews = spark.createDataFrame([], "ingestion_date date, repo_full_name string, pr_number bigint, "
                                        "event_type string, payload string")
    life = lc.pr_lifecycle(stg.stg_pulls(pulls), lc.reviews_agg(stg.stg_reviews(reviews)))
    rows = {r.pr_number: r for r in life.collect()}
    assert rows[1].time_to_merge_hours == -24 and rows[1].review_count == 0
    assert rows[2].updated_at is None  # NULL-strict greatest
    fact = lc.fact_pr_cycle_time(life)
    assert {r.pr_number for r in dq.cycle_time_negative(fact).collect()} == {1}
    assert {r.pr_number for r in dq.pr_dates_invalid(fact, dt.datetime(2024, 3, 1)).collect()} == {1, 2}


def test_calendar_empty_when_bounds_reversed(spark):
    repos = spark.createDataFrame([("o/r",), (None,)], "repo_full_name string")
    bounds = spark.createDataFrame([(dt.date(2024, 1, 3), dt.date(2024, 1, 1))], "min_date date, max_date date")
    assert mart.calendar(repos, bounds).count() == 0
    bounds = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 3))], "min_date date, max_date date")
    assert mart.calendar(repos, bounds).count() == 6


def _direct_backlog(issues, days, stale_days):
    out = {}
    for repo, d in days:
        o = s = 0
        for r, c, u, x in issues:
            if r != repo or c is None:
                continue
            if c <= d and (x is None or x > d):
                o += 1
                if u is not None and (d - u).days > stale_days:
                    s += 1
        out[(repo, d)] = (o, s)
    return out


def test_backlog_deltas_equal_direct_form(spark):
    rnd = random.Random(7)
    base = dt.date(2024, 1, 1)
    issues = []
    for _ in range(400):
        c = base + dt.timedelta(days=rnd.randint(0, 60)) if rnd.random() > 0.05 else None
        x = (c or base) + dt.timedelta(days=rnd.randint(-5, 50)) if rnd.random() > 0.4 else None
        u = (c or base) + dt.timedelta(days=rnd.randint(0, 40)) if rnd.random() > 0.05 else None
        issues.append((rnd.choice(["a/x", "b/y", "c/z"]), c, u, x))
    ts = lambda d: dt.datetime.combine(d, dt.time(12)) if d else None
    fi = spark.createDataFrame([(r, ts(c), ts(u), ts(x)) for r, c, u, x in issues],
                               "repo_full_name string, created_at timestamp, updated_at timestamp, "
                               "closed_at timestamp")
    bounds = spark.createDataFrame([(base, base + dt.timedelta(days=100))], "min_date date, max_date date")
    repos = fi.select("repo_full_name").distinct()
    got = {(r.repo_full_name, r.metric_date): (r.open_issues_count, r.stale_issues_count)
           for r in mart.issue_backlog_daily(fi, mart.calendar(repos, bounds), bounds, 10).collect()}
    days = [(repo, base + dt.timedelta(days=i)) for repo in ["a/x", "b/y", "c/z"] for i in range(101)]
    assert got == _direct_backlog(issues, days, 10)


def test_mart_null_repo_and_empty_input(spark):
    fp = spark.createDataFrame([(None, dt.datetime(2024, 2, 28), None, None, None)],
                               "repo_full_name string, created_at timestamp, merged_at timestamp, "
                               "time_to_first_review_hours bigint, time_to_merge_hours bigint")
    fi = spark.createDataFrame([], "repo_full_name string, created_at timestamp, updated_at timestamp, "
                                   "closed_at timestamp")
    rows = mart.mart_repo_health_daily(fp, fi, AS_OF).collect()
    assert len(rows) == 3 and all(r.prs_created_count == 0 and r.repo_full_name is None for r in rows)
    empty = mart.mart_repo_health_daily(fp.limit(0), fi, AS_OF)
    assert empty.count() == 0
