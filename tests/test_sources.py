"""Cursor gate and source freshness on literal inputs."""

import datetime as dt

from repo_pulse.sources import cursors as cur


def test_freshness_thresholds(spark):
    raw = spark.createDataFrame([(dt.date(2024, 3, 1),), (dt.date(2024, 2, 1),)], "ingestion_date date")
    newest = dt.datetime(2024, 3, 1)
    got = {h: cur.source_freshness({"s": raw}, newest + dt.timedelta(hours=h)).first()["status"]
           for h in (23, 24, 30, 48, 50)}
    assert got == {23: "pass", 24: "pass", 30: "warn", 48: "warn", 50: "error"}


def test_gate_empty_repo_list_means_all(spark):
    c = spark.createDataFrame([("pulls", "o/a", dt.datetime(2024, 1, 2)), ("issues", "o/b", dt.datetime(2024, 1, 2)),
                               ("pulls", "o/c", dt.datetime(2023, 1, 1)), ("other", "o/a", dt.datetime(2024, 1, 2))],
                              "entity string, repo_full_name string, updated_at timestamp")
    start = dt.datetime(2024, 1, 1)
    count = lambda repos: cur.new_data_gate(c, ["pulls", "issues"], start, repos).first()[0]
    assert count(None) == 2 and count([]) == 2 and count(["o/a"]) == 1 and count(["o/c"]) == 0


def test_cursor_lookup_fallback_and_upsert(spark):
    now = dt.datetime(2024, 3, 1)
    cursors = spark.createDataFrame(
        [("pulls", "o/a", dt.datetime(2024, 1, 1), now, now), ("pulls", "o/b", None, now, now)],
        "entity string, repo_full_name string, last_updated_at timestamp, last_success_run timestamp, "
        "updated_at timestamp")
    repos = spark.createDataFrame([("o/a",), ("o/b",), ("o/c",)], "repo_full_name string")
    since = {r.repo_full_name: r.since_ts for r in cur.cursor_lookup(cursors, "pulls", repos, now).collect()}
    assert since == {"o/a": dt.datetime(2024, 1, 1), "o/b": now - dt.timedelta(days=7),
                     "o/c": now - dt.timedelta(days=7)}
    marks = spark.createDataFrame([("pulls", "o/a", dt.datetime(2024, 2, 1)), ("pulls", "o/c", None)],
                                  "entity string, repo_full_name string, max_updated_at timestamp")
    later = dt.datetime(2024, 3, 2)
    out = {r.repo_full_name: r for r in cur.cursor_upsert(cursors, marks, later).collect()}
    assert set(out) == {"o/a", "o/b"}  # no maximum -> no cursor row created
    assert out["o/a"].last_updated_at == dt.datetime(2024, 2, 1) and out["o/a"].updated_at == later
    assert out["o/b"].updated_at == now
