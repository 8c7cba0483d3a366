"""Stream = batch on the same landed files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from repo_pulse.operators import staging as stg
from repo_pulse.operators.dedup import latest_version, version_order
from repo_pulse.plans import catalog
from repo_pulse.session import new_work_dir
from repo_pulse.sources import fixtures as fx
from repo_pulse.sources import landing
from repo_pulse.streaming import streams

from inputs import SF_SMALL


def _same(a, b):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0
    assert b.select(*cols).exceptAll(a.select(*cols)).count() == 0


def test_stream_latest_version_equals_batch(spark):
    root = catalog._land_issue_days(spark, SF_SMALL)
    batch = stg.stg_issues(landing.read_landing(spark, root))
    _same(streams.stream_latest_version(spark, root), batch)


def test_stream_dedup_drops_redeliveries(spark):
    root = catalog._land_issue_days(spark, SF_SMALL, redeliver=True)
    out = streams.stream_dedup(spark, root)
    assert out.count() == out.dropDuplicates(["repo_full_name", "issue_number", "updated_at"]).count()
    batch = stg.parse_issues(landing.read_landing(spark, root)).select(
        "repo_full_name", "issue_number", "updated_at", "ingestion_date").distinct()
    _same(out, batch)


@pytest.mark.parametrize("order, files", [("reverse", 1), ("shuffled", 200), ("reverse", None)])
def test_late_days_count_whatever_the_batch_size(spark, order, files):
    """Three days landed out of order, one of them long after: every stream equals the batch."""
    raw = fx.issues_raw(spark, SF_SMALL)
    root = new_work_dir(spark, "t-late")
    days = {"reverse": [20, 11, 2], "shuffled": [11, 20, 2]}[order]
    for i, d in enumerate(days):
        day = dt.date(2024, 1, d)
        landing.write_landing(raw.filter((F.col("ingestion_date") == F.lit(day)) & F.col("repo_full_name").isin("org/NATION_3", "org/NATION_7")), root, f"r{i}", max_records=0, load_date=day)
    batch = stg.parse_issues(landing.read_landing(spark, root)).filter(F.col("updated_at").isNotNull())
    _same(streams.stream_daily_counts(spark, root, max_files_per_trigger=files),
          batch.groupBy(F.to_date("updated_at").alias("metric_date"), "repo_full_name").agg(F.count("*").alias("issue_events_count")))
    _same(streams.stream_dedup(spark, root, max_files_per_trigger=files),
          batch.groupBy("repo_full_name", "issue_number", "updated_at").agg(F.min("ingestion_date").alias("ingestion_date")))


def test_stream_staging_of_pulls_and_reviews(spark):
    for entity, raw, build, numbered in (("pulls", fx.pulls_raw, stg.stg_pulls, False), ("pr_reviews", fx.reviews_raw, None, True)):
        root = new_work_dir(spark, f"t-{entity}")
        rows = raw(spark, SF_SMALL).filter(F.col("repo_full_name").isin("org/NATION_3", "org/NATION_7"))
        landing.write_landing(rows, root, "r1", load_date=dt.date(2024, 3, 1))
        landed = landing.read_landing(spark, root, numbered)
        want = build(landed) if build else latest_version(stg.parse_reviews(landed).filter(F.col("review_id").isNotNull()), ["repo_full_name", "review_id"], version_order())
        got = streams.stream_latest_version(spark, root, entity)
        _same(got.drop("_tie"), want.drop("_tie"))
