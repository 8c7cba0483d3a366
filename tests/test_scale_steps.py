"""Steps that all queries share: stored tables, one parse of arrived rows, models that are views."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from repo_pulse.operators import history as hist
from repo_pulse.operators import lifecycle as lc
from repo_pulse.operators import mart, part_table
from repo_pulse.operators import staging as stg
from repo_pulse.operators import upsert as up
from repo_pulse.plans import catalog, daily, job
from repo_pulse.session import DROP_SHUFFLES, SPLIT_BYTES, ensure_session_settings, new_work_dir, shuffles_dropped
from repo_pulse.sources import fixtures as fx
from inputs import SF_SMALL


class _Frame:
    """A DataFrame's write path as ``write_table`` sees it; any shuffle on the way is an error."""

    def __init__(self, df, master):
        self.df, self.sparkSession = df, type("S", (), {"sparkContext": type("C", (), {"master": master, "defaultParallelism": 2})})
        self.write = df.write

    def hint(self, *_):
        raise AssertionError("rows are shuffled again before the write")

    repartition = hint


def test_a_cluster_stores_rows_without_another_shuffle(spark, tmp_path):
    fx.write_table(_Frame(spark.range(10), "spark://somewhere:7077"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 10


def test_scan_tasks_are_bounded(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    ensure_session_settings(spark)
    assert int(spark.conf.get("spark.sql.files.maxPartitionBytes")) == SPLIT_BYTES
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    ensure_session_settings(spark)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "1m"
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _review(review, pr, at, state="APPROVED"):
    return (dt.date(2024, 1, 1), "o/a", pr, "pr_review", json.dumps({"id": review, "state": state, "submitted_at": at, "user": {"login": "u", "id": 1}}))


RAW = "ingestion_date date, repo_full_name string, pr_number bigint, event_type string, payload string"


def test_arrived_rows_are_parsed_once(spark):
    one = spark.createDataFrame([_review(1, 10, "2024-01-02T00:00:00Z"), _review(2, 10, "2024-01-02T00:00:00Z")], RAW)
    first, _ = up.review_versions_update(stg.parse_reviews(one).limit(0), one)
    first = up.commit_version(first, "review_versions")
    two = spark.createDataFrame([_review(1, 11, "2024-01-03T00:00:00Z"), _review(1, 12, "2024-01-02T12:00:00Z"),
                                 _review(3, 13, "2024-01-03T00:00:00Z"), _review(2, 10, "2024-01-01T00:00:00Z", "PENDING")], RAW)
    table, changed = up.review_versions_update(first, two)
    for df in (table, changed):
        assert "from_json" not in df._jdf.queryExecution().optimizedPlan().toString().lower().replace("jsontostructs", "from_json")
    assert sorted((r["review_id"], r["pr_number"], r["review_state"]) for r in table.collect()) == [(1, 11, "APPROVED"), (2, 10, "APPROVED"), (3, 13, "APPROVED")]
    assert {r["pr_number"] for r in changed.collect()} == {10, 11, 13}


@pytest.mark.parametrize("name", sorted(catalog.VIEWS))
def test_projection_models_are_not_stored(spark, name, monkeypatch):
    built = []
    monkeypatch.setattr(fx, "stored", lambda s, n, b, d, **k: built.append(n) or b(s, d, **k))
    monkeypatch.setitem(catalog.MODEL_BUILDERS, name, lambda s, d: s.range(1))
    assert catalog.model(spark, "none", name).count() == 1 and built == []


def test_iso_z_fraction_only_when_there_is_one(spark):
    times = ["1969-12-31 23:59:59.5", "1969-12-31 23:59:59", "2024-01-01 00:00:00.000001", "2024-01-01 00:00:00", None]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(fx.iso_z(F.col("t").cast("timestamp")).alias("a"), fx.iso_z(F.col("t").cast("timestamp_ntz")).alias("b"))
    want = ["1969-12-31T23:59:59.500000Z", "1969-12-31T23:59:59Z", "2024-01-01T00:00:00.000001Z", "2024-01-01T00:00:00Z", None]
    assert [r["a"] for r in df.collect()] == want and [r["b"] for r in df.collect()] == want


def test_review_counts_do_not_store_their_reviews(spark, monkeypatch):
    built = []
    monkeypatch.setattr(fx, "stored", lambda s, n, b, d, **k: built.append(n))
    raw = spark.createDataFrame([_review(r, 7, "2024-01-02T00:00:00Z") for r in range(3)], RAW)
    monkeypatch.setattr(fx, "reviews_raw", lambda s, d: raw)
    out = catalog.REGISTRY["int_pr_reviews_agg"](spark, "none")
    assert "review_body" not in out._jdf.queryExecution().optimizedPlan().toString()  # columns the counts do not use are not dealt out
    assert [r["review_count"] for r in out.collect()] == [3] and built == []


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


PR_FACT = "repo_full_name string, created_at timestamp, merged_at timestamp, time_to_first_review_hours bigint, time_to_merge_hours bigint"
ISSUE_FACT = "repo_full_name string, created_at timestamp, updated_at timestamp, closed_at timestamp"


def test_mart_reads_each_fact_once(spark, tmp_path):
    t = lambda d: dt.datetime(2024, 2, d, 12)
    spark.createDataFrame([("o/a", t(27), t(28), 2, 24), ("o/a", t(27), None, None, None), ("o/a", None, t(28), 5, 6),
                           (None, t(26), t(27), 1, 1)], PR_FACT).write.parquet(str(tmp_path / "pr"))
    spark.createDataFrame([("o/a", t(27), t(27), t(29)), ("o/b", t(25), t(25), t(20)), ("o/c", None, t(27), t(28)),
                           ("o/a", t(28), None, None)], ISSUE_FACT).write.parquet(str(tmp_path / "issue"))
    fp, fi = (spark.read.parquet(str(tmp_path / name)) for name in ("pr", "issue"))
    assert _plan(mart.day_sums(fp, fi)).count("Relation [") == 2
    out = mart.mart_repo_health_daily(fp, fi, dt.date(2024, 2, 29), stale_days=1)
    assert not [f for f in out.inputFiles() if f.endswith(".parquet") and str(tmp_path) in f]  # bounds, repos and rows come from the day sums
    rows = {(r["repo_full_name"], r["metric_date"].day): tuple(r)[2:] for r in out.collect()}
    assert set(rows) == {(repo, day) for repo in ("o/a", "o/b", "o/c", None) for day in range(25, 30)}
    assert rows["o/a", 27] == (2, 0, 1, 0, 2.0, None)
    assert rows["o/a", 28] == (0, 2, 2, 0, None, 15.0)
    assert rows["o/a", 29] == (0, 0, 1, 0, None, None)
    assert all(v == (0, 0, 0, 0, None, None) for (repo, _), v in rows.items() if repo != "o/a")


@pytest.mark.parametrize("name", ["calendar", "mart_repo_health_daily", "repo_list", "date_bounds"])
def test_queries_that_read_a_fact_once_store_no_model(spark, name, monkeypatch):
    stored, built = fx.stored, []
    monkeypatch.setattr(fx, "is_stored", lambda *_: False)
    monkeypatch.setattr(fx, "stored", lambda s, n, b, d, **k: built.append(n) or stored(s, n, b, d, **k))
    assert catalog.REGISTRY[name](spark, SF_SMALL).count() > 0
    assert built and not [n for n in built if n.startswith("model-")]


def test_calendar_is_taken_from_first_days(spark, tmp_path, monkeypatch):
    spark.createDataFrame([("o/a", dt.datetime(2024, 2, 28, 5)), ("o/a", dt.datetime(2024, 2, 29)), (None, None)], "repo_full_name string, created_at timestamp").write.parquet(str(tmp_path / "pr"))
    fact = spark.read.parquet(str(tmp_path / "pr"))
    monkeypatch.setattr(catalog, "_fact_pr_once", lambda s, d: fact)
    monkeypatch.setattr(catalog, "_fact_issue_once", lambda s, d: fact.limit(0))
    out = catalog.REGISTRY["calendar"](spark, "none")
    assert not [f for f in out.inputFiles() if str(tmp_path) in f]
    assert sorted((r["repo_full_name"] or "", r["metric_date"].day) for r in out.collect()) == [("", 1), ("", 28), ("", 29), ("o/a", 1), ("o/a", 28), ("o/a", 29)]


def test_snapshot_merge_joins_once(spark, tmp_path):
    cols = "repo_full_name string, pr_number bigint, pull_request_id bigint, pull_request_state string, pull_request_title string, author_login string, is_draft boolean, created_at timestamp, updated_at timestamp, closed_at timestamp, merged_at timestamp"
    day = lambda d: dt.datetime(2024, 1, d)
    snap = lambda *rows: spark.createDataFrame([("o/a", n, n, "open", "t", "u", False, day(1), day(d), None, None) for n, d in rows], cols)
    h = up.commit_version(hist.scd2_merge(None, snap((1, 2), (2, 2), (3, 2)), day(3)), "t_once")
    h = up.commit_version(hist.scd2_merge(h, snap((1, 5), (3, 2)), day(6)), "t_once")
    out = hist.scd2_merge(h, snap((1, 5), (2, 2), (4, 7)), day(8))
    assert _plan(out).count("Join FullOuter") == 1
    end = lambda t: t.day if t else None
    got = sorted(((r["pr_number"], r["valid_from"].day, end(r["valid_to"])) for r in out.collect()), key=str)
    assert got == [(1, 2, 5), (1, 5, None), (2, 2, 6), (2, 6, None), (3, 2, 8), (4, 7, None)]


def test_pulls_without_every_tenth_key_are_read_from_the_whole_table(spark, monkeypatch):
    want = fx.build_pulls_raw(spark, SF_SMALL, drop_mod10=True)
    stored, built = fx.stored, []
    monkeypatch.setattr(fx, "stored", lambda s, n, b, d, **k: built.append(k) or stored(s, n, b, d, **k))
    got = fx.pulls_raw(spark, SF_SMALL, drop_mod10=True)
    assert built == [{"versions": (0, 1)}]
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


# ---------------------------------------------------------------- merges of arrived rows


def _pull(number, created, updated, repo="o/a"):
    t = lambda d: f"{d}T00:00:00Z"
    return (dt.date.fromisoformat(updated), repo, "pull", json.dumps({"number": number, "id": number, "state": "open", "title": "t", "created_at": t(created), "updated_at": t(updated)}))


def _issue(number, created, updated):
    t = lambda d: f"{d}T00:00:00Z"
    return (dt.date.fromisoformat(updated), "o/a", "issue", json.dumps({"number": number, "id": number, "state": "open", "title": "t", "labels": [], "created_at": t(created), "updated_at": t(updated)}))


PULL_RAW = "ingestion_date date, repo_full_name string, event_type string, payload string"


def _batches(spark):
    """Two arrivals: PR 1 is written again and reviewed later, a review moves from PR 2 to PR 1, PR 3 and a PR without a repo are new."""
    one = {"pulls": [_pull(1, "2022-01-01", "2022-01-02"), _pull(2, "2023-01-01", "2023-01-02"), _pull(9, "2022-05-01", "2022-05-02", None)],
           "issues": [_issue(5, "2022-01-01", "2022-01-02"), _issue(6, "2023-01-01", "2023-01-01")],
           "pr_reviews": [_review(10, 1, "2022-01-03T00:00:00Z"), _review(11, 2, "2023-02-01T00:00:00Z"), _review(12, 2, "2023-02-02T00:00:00Z")]}
    two = {"pulls": [_pull(1, "2022-01-01", "2023-06-01"), _pull(3, "2023-07-01", "2023-07-02"), _pull(9, "2022-05-01", "2023-05-02", None), _pull(2, "2023-01-01", "2022-12-31")],
           "issues": [_issue(5, "2022-01-01", "2023-03-01"), _issue(7, "2023-03-01", "2023-03-02")],
           "pr_reviews": [_review(11, 1, "2023-05-01T00:00:00Z"), _review(13, 3, "2023-07-03T00:00:00Z"), _review(12, 2, "2023-02-01T00:00:00Z", "DISMISSED")]}
    frame = lambda e, rows: spark.createDataFrame(rows, RAW if e == "pr_reviews" else PULL_RAW)
    return [{e: frame(e, rows) for e, rows in b.items()} for b in (one, two)]


def _rows(df, like):
    return sorted(map(str, df.select(*sorted(like.columns)).collect()))


def _rebuilt(one, two, as_of):
    raw = {e: one[e].unionByName(two[e]) for e in one}
    pulls, reviews = stg.stg_pulls(raw["pulls"]), stg.stg_reviews(raw["pr_reviews"])
    agg = lc.reviews_agg(reviews)
    life = lc.pr_lifecycle(pulls, agg)
    issues = lc.issue_lifecycle(stg.stg_issues(raw["issues"]), as_of)
    fact = lc.fact_pr_cycle_time(life)
    return {"stg_pulls": pulls, "stg_reviews": reviews, "int_pr_reviews_agg": agg, "int_pr_lifecycle": life, "int_issue_lifecycle": issues,
            "fact_pr_cycle_time": fact, "mart_repo_health_daily": mart.mart_repo_health_daily(fact, lc.fact_issue_aging(issues), as_of)}


def test_a_first_run_writes_its_rows_once_and_few_partitions_without_a_shuffle(spark, monkeypatch):
    """no copy of the arrived rows beside a new table, and no rebalance before a write to a few years."""
    stored, dealt = [], []
    commit, spread = daily.commit_version, part_table.rebalanced
    monkeypatch.setattr(daily, "commit_version", lambda df, name, **k: stored.append(name) or commit(df, name, **k))
    monkeypatch.setattr(part_table, "rebalanced", lambda df, by: dealt.append(by) or spread(df, by))
    one, two = _batches(spark)
    root, as_of = new_work_dir(spark, "t-first"), dt.date(2023, 8, 1)
    first = daily.transform_touched(daily.Tables(), one, root, as_of, unit="year", buckets=1)
    tables = set(daily.LAYOUT) - {"mart_sums", "mart_repo_health_daily"}
    assert not [n for n in stored if n.removeprefix("arrived_").removesuffix("_arrived") in tables]
    second = daily.transform_touched(first, two, root, as_of, unit="year", buckets=1)
    assert dealt == [] or all("mart" in str(d) for d in dealt)
    views = second.views()
    for name, want in _rebuilt(one, two, as_of).items():
        assert _rows(views[name], want) == _rows(want, want), name
    assert {r["pr_number"] for r in second.changed_prs.collect()} == {1, 2, 3, 9}


def test_writes_drop_their_shuffles(spark, tmp_path):
    before = spark.conf.get(DROP_SHUFFLES)
    with shuffles_dropped(spark):
        assert spark.conf.get(DROP_SHUFFLES) == "true"
    assert spark.conf.get(DROP_SHUFFLES) == before
    with pytest.raises(ZeroDivisionError), shuffles_dropped(spark):
        1 / 0  # noqa: B018
    assert spark.conf.get(DROP_SHUFFLES) == before
    rows = spark.range(4).groupBy((F.col("id") % 2).alias("k")).count()
    assert up.commit_version(rows, "t_dropped", at=str(tmp_path)).count() == rows.count() == 2  # rows' own plan keeps its shuffles
    assert spark.conf.get(DROP_SHUFFLES) == before


def test_a_first_job_run_merges_with_nothing(spark, monkeypatch):
    """without tables before, arrived versions are the tables; refreshed lifecycle rows are computed once for lifecycle and fact."""
    stored, commit = [], up.commit_version
    for module in (up, job):
        monkeypatch.setattr(module, "commit_version", lambda df, name, *a, **k: stored.append((name, _plan(df))) or commit(df, name, *a, **k))
    one, two = _batches(spark)
    as_of = dt.date(2023, 8, 1)
    first = job.transform_incremental(one, as_of, fact_partitions=None)
    assert not [n for n, plan in stored if n.startswith(("arrived", "changed")) or "LeftAnti" in plan or "LeftSemi" in plan]
    del stored[:]
    second = job.transform_incremental(two, as_of, first, fact_partitions=None)
    fact = next(plan for n, plan in stored if n == "fact_pr_cycle_time")
    assert "fresh_pr_lifecycle" in [n for n, _ in stored] and fact.count("Join LeftSemi") == 1
    for name, want in _rebuilt(one, two, as_of).items():
        assert _rows(second[name], want) == _rows(want, want), name


def _small_tables(spark, monkeypatch):
    one, two = _batches(spark)
    monkeypatch.setattr(fx, "SPLIT_DATE", dt.date(2023, 3, 1))
    raw = {e: one[e].unionByName(two[e]) for e in one}
    monkeypatch.setattr(fx, "pulls_raw", lambda s, d, **k: raw["pulls"].filter("repo_full_name is not null"))
    monkeypatch.setattr(fx, "reviews_raw", lambda s, d: raw["pr_reviews"].withColumn("ingestion_date", F.to_date(F.get_json_object("payload", "$.submitted_at"))))
    return lc.pr_lifecycle(stg.stg_pulls(fx.pulls_raw(spark, "")), lc.reviews_agg(stg.stg_reviews(fx.reviews_raw(spark, ""))))


def test_partitioned_roundtrip_refreshes_changed_prs_only(spark, monkeypatch):
    """the fresh rows are not taken from the whole lifecycle, and every folder is stored as other tables are."""
    life = _small_tables(spark, monkeypatch)
    plans, commit = {}, up.commit_version
    monkeypatch.setattr(up, "commit_version", lambda df, name, *a, **k: plans.setdefault(name, _plan(df)) and commit(df, name, *a, **k))
    out = catalog.REGISTRY["partitioned_roundtrip"](spark, "none")
    assert all(".zstd." in f for f in out.inputFiles())
    assert "LeftAnti" not in plans["fresh_fact_pr"]
    want = catalog.boundary(lc.fact_pr_cycle_time(life))
    assert _rows(out, want) == _rows(want, want)


def test_refreshed_lifecycle_is_dealt_out_once(spark, tmp_path, monkeypatch):
    """pulls and counts matched with the changed keys are joined where they lie; a PR without a repo has no counts."""
    life_cols = ["pull_request_id", "pull_request_state", "pull_request_title", "author_login", "author_id", "is_draft", "additions_count", "deletions_count",
                 "changed_files_count", "comments_count", "review_comments_count", "commits_count"]
    day = dt.datetime(2024, 1, 1)
    pulls = spark.createDataFrame([(r, n, day, day, None, None) for r, n in (("o/a", 1), ("o/a", 2), (None, 1))],
                                  "repo_full_name string, pr_number bigint, created_at timestamp, updated_at timestamp, closed_at timestamp, merged_at timestamp")
    pulls = pulls.withColumns({c: F.lit(1) for c in life_cols})
    agg = spark.createDataFrame([(r, n, day, day) for r, n in (("o/a", 1), (None, 1), ("o/a", 3))], "repo_full_name string, pr_number bigint, first_review_at timestamp, updated_at timestamp")
    agg = agg.withColumns({c: F.lit(4).cast("bigint") for c in lc.REVIEW_COUNTS})
    keys = spark.createDataFrame([("o/a", 1), (None, 1), ("o/b", 1)], "repo_full_name string, pr_number bigint")
    for name, df in (("pulls", pulls), ("agg", agg), ("keys", keys)):
        df.write.parquet(str(tmp_path / name))
    pulls, agg, keys = (spark.read.parquet(str(tmp_path / n)) for n in ("pulls", "agg", "keys"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = up.pr_lifecycle_incremental(lc.pr_lifecycle(pulls, agg).limit(0), pulls, agg, keys, keys)
        plan = up.pr_lifecycle_of(pulls, agg, keys)._jdf.queryExecution().executedPlan().toString()
        got = sorted(((r["repo_full_name"] or "", r["pr_number"], r["review_count"]) for r in out.collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len([line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]) <= 4
    assert got == [("", 1, 0), ("o/a", 1, 4)]


def test_a_merge_adds_to_partitions_without_a_changed_key(spark):
    """only partitions that hold a changed key are written anew; one with many folders is, too."""
    cols = "k long, y long"
    table = part_table.PartTable(spark, new_work_dir(spark, "t-adds"), spark.createDataFrame([], cols).schema, "y")
    put = lambda t, *rows: t.merged((df := spark.createDataFrame(list(rows), cols)).select("k"), df, ["k"])
    table = put(table, (1, 2022), (2, 2023))
    after = put(table, (3, 2023), (4, 2024))
    assert after.parts["2022"] == table.parts["2022"] and after.parts["2023"][:1] == table.parts["2023"] and len(after.parts["2023"]) == 2
    moved = put(after, (1, 2023))
    assert "2022" not in moved.parts and moved.parts["2024"] == after.parts["2024"] and len(moved.parts["2023"]) == 3
    for k in range(10, 10 + part_table.MOST_VERSIONS):
        moved = put(moved, (k, 2023))
        assert len(moved.parts["2023"]) <= part_table.MOST_VERSIONS
    assert sorted(map(tuple, moved.read().collect())) == sorted([(1, 2023), (2, 2023), (3, 2023), (4, 2024), *[(k, 2023) for k in range(10, 10 + part_table.MOST_VERSIONS)]])


@pytest.mark.parametrize("many", [True, False])
def test_rows_around_keys(spark, many):
    """many keys are not looked up before all rows are read; few are, and their partitions alone are read."""
    rows = spark.createDataFrame([(k, k % 4) for k in range(100)], "k long, y long")
    table = part_table.PartTable(spark, new_work_dir(spark, "t-around"), rows.schema, "y").appended(rows)
    keys = up.commit_version(spark.range(50 if many else 1).select(F.col("id").alias("k")), "t_keys")
    assert {r["y"] for r in table.around(keys, ["k"]).collect()} == ({0, 1, 2, 3} if many else {0})
    assert {r["k"] for r in table.rows_of(keys, ["k"]).collect()} == set(range(50 if many else 1))


def test_reviews_are_counted_before_they_are_matched(spark, tmp_path):
    """the counts of changed PRs, not their reviews, meet the keys; few keys are matched with the reviews."""
    stg.parse_reviews(spark.createDataFrame([_review(i, i % 3, "2024-01-02T00:00:00Z") for i in range(9)] + [_review(20, None, "2024-01-02T00:00:00Z")], RAW)).write.parquet(str(tmp_path / "r"))
    spark.createDataFrame([("o/a", 1), (None, 2)], "repo_full_name string, pr_number bigint").write.parquet(str(tmp_path / "k"))
    reviews, keys = (spark.read.parquet(str(tmp_path / n)) for n in "rk")
    order = lambda: [w for line in _plan(up.reviews_agg_of(reviews, keys)).splitlines() for w in ("LeftSemi", "Aggregate") if w in line]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert order()[0] == "LeftSemi"
        agg = lc.reviews_agg(reviews)
        got = up.reviews_agg_incremental(agg, reviews, keys)
        assert sorted((r["pr_number"], r["review_count"]) for r in got.collect() if r["pr_number"] is not None) == [(0, 3), (1, 3), (2, 3)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert order()[0] == "Aggregate"


def test_replaced_versions_are_not_kept(spark, monkeypatch):
    """versions that later ones replace, and arrived rows, leave once they are merged."""
    _small_tables(spark, monkeypatch)
    gone, remove = [], catalog.delete
    monkeypatch.setattr(catalog, "delete", lambda s, path: gone.append(path) or remove(s, path))
    s = catalog._incremental(spark, "none")
    assert len(gone) == 1 and s["life_2"].count() == 3
    assert not [f for df in s.values() for f in df.inputFiles() if gone[0] in f]
