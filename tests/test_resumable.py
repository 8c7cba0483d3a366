"""Streams that go on where the call before ended."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from repo_pulse.operators import staging as stg
from repo_pulse.session import new_work_dir
from repo_pulse.sources import landing
from repo_pulse.streaming import resumable as rs


def issue(repo, number, updated):
    return '{"number":%d,"id":%d,"state":"open","title":"t","created_at":"2024-01-01T00:00:00Z","updated_at":"%s"}' % (number, number, updated)


def land(spark, root, run, day, found):
    rows = spark.createDataFrame([(day, repo, "issue", issue(repo, n, t)) for repo, n, t in found], landing.LANDING_SCHEMA).coalesce(1)
    landing.write_landing(rows, root, run, load_date=day)


def day(k):
    return dt.date(2024, 1, 1) + dt.timedelta(days=k)


def got(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_versions_resume_compact_and_survive_a_failed_batch(spark, monkeypatch):
    root, out = new_work_dir(spark, "t-landing"), new_work_dir(spark, "t-stream")
    land(spark, root, "r1", day(1), [("o/a", 1, "2024-01-01T10:00:00Z"), ("o/a", 2, "2024-01-01T11:00:00Z")])
    table, run = rs.versions(spark, root, out)
    assert run.input_rows == 2 and table.count() == 2
    land(spark, root, "r2", day(2), [("o/a", 1, "2024-01-02T10:00:00Z")])
    with monkeypatch.context() as m:
        m.setattr(rs.Parts, "write", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            rs.versions(spark, root, out)
    table, run = rs.versions(spark, root, out, compact_every=2)
    assert run.input_rows == 1  # only the new file, again
    want = stg.stg_issues(landing.read_landing(spark, root))
    assert got(table) == got(want)
    path, through = run.parts.base()
    assert path and through == run.last_batch
    land(spark, root, "r3", day(3), [("o/b", 1, "2024-01-03T10:00:00Z"), ("o/a", 2, "2024-01-01T09:00:00Z")])
    table, run = rs.versions(spark, root, out, compact_every=5)
    assert run.input_rows == 2 and got(table) == got(stg.stg_issues(landing.read_landing(spark, root)))
    table, run = rs.versions(spark, root, out)
    assert run.input_rows == 0 and table.count() == 3


def test_daily_counts_carry_open_days_only(spark):
    root, out = new_work_dir(spark, "t-landing"), new_work_dir(spark, "t-stream")
    assert rs.totals(spark, out).isEmpty()
    every = []
    for k in range(6):
        found = [(repo, 10 * k + i, f"{day(k)}T{10 + i}:00:00Z") for repo in ("o/a", "o/b") for i in range(2)]
        if k == 4:
            found.append(("o/a", 999, f"{day(1)}T05:00:00Z"))  # long closed
        every += found
        land(spark, root, f"r{k}", day(k), found)
        rs.daily_counts(spark, root, out)
    marks = rs.progress(spark, out).orderBy("batch_id").collect()
    assert max(r["open_rows"] for r in marks) <= 4 and sum(r["late_rows"] for r in marks) == 1  # two open days of two repos, however many days passed
    batch = stg.parse_issues(landing.read_landing(spark, root)).filter(F.col("updated_at").isNotNull())
    assert got(rs.totals(spark, out)) == got(batch.groupBy(F.to_date("updated_at").alias("metric_date"), "repo_full_name").agg(F.count("*").alias("issue_events_count")))
    final = {(r["metric_date"], r["repo_full_name"]): r["issue_events_count"] for r in rs.final_days(spark, out).collect()}
    assert final[(day(1), "o/a")] == 2 and (day(5), "o/a") not in final  # a final day stays final


def test_dedup_drops_redeliveries_by_state(spark):
    root, out = new_work_dir(spark, "t-landing"), new_work_dir(spark, "t-stream")
    first = [("o/a", n, f"2024-01-01T{n:02d}:00:00Z") for n in range(1, 6)]
    land(spark, root, "r1", day(1), first)
    _, run = rs.deduplicated(spark, root, out)
    land(spark, root, "r2", day(2), first[:3] + [("o/b", 1, "2024-01-02T01:00:00Z")])
    table, run = rs.deduplicated(spark, root, out)
    assert run.input_rows == 4 and run.parts.read().count() == 6  # three repeats never reached a part
    batch = stg.parse_issues(landing.read_landing(spark, root)).filter(F.col("updated_at").isNotNull())
    assert got(table) == got(batch.groupBy(*rs.DEDUP_KEY).agg(F.min("ingestion_date").alias("ingestion_date")))
