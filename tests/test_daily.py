"""Daily runs on durable tables: incremental = full rebuild, and only touched partitions are written."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from repo_pulse.operators import history as hist
from repo_pulse.operators import lifecycle as lc
from repo_pulse.operators import mart
from repo_pulse.operators import quality as dq
from repo_pulse.operators.part_table import PartTable, day_of
from repo_pulse.operators.upsert import DuplicateKeyError
from repo_pulse.plans import daily, job
from repo_pulse.session import new_work_dir
from repo_pulse.sources import landing

REPOS = ["o/a", "o/b", "o/c"]


def same(a, b):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    assert sorted(map(str, a.select(*cols).collect())) == sorted(map(str, b.select(*cols).collect()))


def local(path: str) -> str:
    return path.removeprefix("file:").replace("//", "/")


def files(table: PartTable) -> dict[str, dict[str, int]]:
    """{partition: {file: time of writing}}"""
    out = {}
    for p in table.parts:
        out[p] = {}
        for folder in table.paths(p):
            for f in os.listdir(local(folder)):
                if f.endswith(".parquet"):
                    out[p][f"{folder}/{f}"] = os.stat(f"{local(folder)}/{f}").st_mtime_ns
    return out


# ---------------------------------------------------------------- PartTable

SCHEMA = "k long, at timestamp, v string"


def rows(spark, *found):
    return spark.createDataFrame([(k, None if at is None else dt.datetime.fromisoformat(at), v) for k, at, v in found], SCHEMA)


@pytest.fixture
def table(spark):
    empty = PartTable(spark, new_work_dir(spark, "t-part"), rows(spark).schema, day_of("at"), ("k",))
    first = rows(spark, (1, "2024-01-01", "a"), (2, "2024-01-01", "b"), (3, "2024-01-02", "c"), (4, "2024-01-03", "d"), (None, None, "n"))
    return empty.merged(first.select("k"), first, ["k"])


def got(t):
    return sorted(((r["k"] or 0, str(r["at"])[:10], r["v"]) for r in t.read().collect()))


def test_merge_rewrites_old_and_new_place_only(spark, table):
    before = files(table)
    moved = rows(spark, (3, "2024-01-04", "moved"), (1, "2024-01-01", "new"))
    after = table.merged(moved.select("k"), moved, ["k"])
    assert got(after) == [(0, "None", "n"), (1, "2024-01-01", "new"), (2, "2024-01-01", "b"), (3, "2024-01-04", "moved"), (4, "2024-01-03", "d")]
    assert sorted(after.parts) == ["2024-01-01", "2024-01-03", "2024-01-04", "none"]  # the emptied day is gone
    now = files(after)
    assert now["2024-01-03"] == before["2024-01-03"] and now["none"] == before["none"]
    assert now["2024-01-01"].keys().isdisjoint(before["2024-01-01"])
    assert got(table)[3] == (3, "2024-01-02", "c")  # the version before stays readable


def test_merge_deletes_keys_without_a_fresh_row_and_matches_null_keys(spark, table):
    gone = spark.createDataFrame([(4,), (None,)], "k long")
    after = table.merged(gone, rows(spark, (None, "2024-01-02", "dated")), ["k"])
    assert got(after) == [(0, "2024-01-02", "dated"), (1, "2024-01-01", "a"), (2, "2024-01-01", "b"), (3, "2024-01-02", "c")]
    assert "none" not in after.parts and "2024-01-03" not in after.parts


def test_merge_of_nothing_is_the_same_table(spark, table):
    none = rows(spark)
    assert table.merged(none.select("k"), none, ["k"]) is table
    empty = PartTable(spark, new_work_dir(spark, "t-part"), none.schema, day_of("at"))
    assert empty.merged(none.select("k"), none, ["k"]).read().isEmpty()


def test_merge_refuses_duplicate_keys(spark, table):
    twice = rows(spark, (9, "2024-01-05", "x"), (9, "2024-01-06", "y"))
    with pytest.raises(DuplicateKeyError):
        table.merged(twice.select("k"), twice, ["k"], check_keys=True)


def test_manifest_roundtrip_bounds_and_retirement(spark, table):
    path = table.save()
    back = PartTable.load(spark, path, table.describe())
    assert back == table
    assert {r["k"] for r in back.between("2024-01-02", "2024-01-03").collect()} == {3, 4}
    more = rows(spark, (5, "2024-01-03", "e"))
    after = back.appended(more)
    assert len(after.parts["2024-01-03"]) == 2 and {r["k"] for r in after.between("2024-01-03", "2024-01-03").collect()} == {4, 5}
    assert PartTable.load(spark, after.save(), after.describe()) == after
    merged = after.merged(more.select("k"), more, ["k"])
    assert len(merged.parts["2024-01-03"]) == 1
    assert after.retire([merged]) == 2  # both folders of the day, none of the days they share
    assert len(got(merged)) == 6


def test_a_filter_on_the_clustering_column_skips_row_groups(spark):
    """Footers of a sorted file have narrow bounds, so a repo filter reads few row groups."""
    import pyarrow.parquet as pq

    many = spark.range(200_000).select(F.col("id").alias("k"), F.lit(dt.datetime(2024, 1, 1)).alias("at"), F.format_string("repo-%03d", F.col("id") * 7919 % 400).alias("v"))
    spark.sparkContext._jsc.hadoopConfiguration().setInt("parquet.block.size", 16 * 1024)
    spark.sparkContext._jsc.hadoopConfiguration().setInt("parquet.page.size", 4 * 1024)
    try:
        t = PartTable(spark, new_work_dir(spark, "t-skip"), many.schema, day_of("at"), ("v",)).replaced(["2024-01-01"], many)
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.page.size")
    bounds = []
    for f in files(t)["2024-01-01"]:
        meta = pq.ParquetFile(local(f)).metadata
        column = meta.schema.names.index("v")
        bounds += [meta.row_group(i).column(column).statistics for i in range(meta.num_row_groups)]
    hit = [s for s in bounds if s.min <= "repo-123" <= s.max]
    assert len(bounds) >= 8 and len(hit) * 4 <= len(bounds)
    assert t.read().filter("v = 'repo-123'").count() == 500


# ---------------------------------------------------------------- runs


def pull(repo, number, created, updated, merged=None):
    return (repo, "pull", '{"number":%d,"id":%d,"state":"open","title":"t","user":{"login":"u","id":1},"created_at":"%sT00:00:00Z","updated_at":"%sT00:00:00Z"%s}' % (
        number, number, created, updated, f',"merged_at":"{merged}T00:00:00Z"' if merged else ""))


def issue(repo, number, created, updated, closed=None):
    return (repo, "issue", '{"number":%d,"id":%d,"state":"%s","title":"t","user":{"login":"u","id":1},"labels":[],"created_at":"%sT00:00:00Z","updated_at":"%sT00:00:00Z"%s}' % (
        number, number, "closed" if closed else "open", created, updated, f',"closed_at":"{closed}T00:00:00Z"' if closed else ""))


def review(repo, pr, number, at):
    return (repo, "pr_review", '{"id":%d,"state":"APPROVED","user":{"login":"r%d"},"submitted_at":"%sT05:00:00Z"}' % (number, number, at), pr)


class World:
    """Landing, raw and table folders of one little organisation."""

    def __init__(self, spark):
        self.spark = spark
        self.roots = {e: new_work_dir(spark, f"t-landing-{e}") for e in job.ENTITIES}
        self.raws = {e: new_work_dir(spark, f"t-raw-{e}") for e in job.ENTITIES}
        self.root = new_work_dir(spark, "t-tables")

    def land(self, run, day, pulls=(), issues=(), reviews=()):
        plain = "ingestion_date date, repo_full_name string, event_type string, payload string"
        for entity, found in (("pulls", pulls), ("issues", issues)):
            landing.write_landing(self.spark.createDataFrame([(day, *r) for r in found], plain), self.roots[entity], run, load_date=day)
        found = self.spark.createDataFrame([(day, r, pr, e, p) for r, e, p, pr in reviews], landing.REVIEW_LANDING_SCHEMA)
        landing.write_landing(found, self.roots["pr_reviews"], run, load_date=day)

    def run(self, run, day, **options):
        return daily.run_daily(self.spark, self.roots, self.raws, self.root, day, dt.datetime.combine(day, dt.time(12)), runs=[run], **options)

    def full(self, day):
        raw = {e: self.spark.read.parquet(self.raws[e]) for e in job.ENTITIES}
        from repo_pulse.operators import staging as stg

        pulls, issues, reviews = stg.stg_pulls(raw["pulls"]), stg.stg_issues(raw["issues"]), stg.stg_reviews(raw["pr_reviews"])
        agg = lc.reviews_agg(reviews)
        life, ilife = lc.pr_lifecycle(pulls, agg), lc.issue_lifecycle(issues, day)
        fact, ifact = lc.fact_pr_cycle_time(life), lc.fact_issue_aging(ilife)
        return {"stg_pulls": pulls, "stg_issues": issues, "stg_reviews": reviews, "int_pr_reviews_agg": agg, "int_pr_lifecycle": life, "int_issue_lifecycle": ilife,
                "fact_pr_cycle_time": fact, "fact_issue_aging": ifact, "mart_repo_health_daily": mart.mart_repo_health_daily(fact, ifact, day)}

    def check(self, tables, day):
        views, full = tables.views(), self.full(day)
        for name in ("stg_reviews", "int_pr_reviews_agg", "int_pr_lifecycle", "fact_pr_cycle_time", "fact_issue_aging", "mart_repo_health_daily"):
            same(views[name], full[name])
        same(views["dq_report"], dq.report(full, dt.datetime.combine(day, dt.time())))


def first_run(world, day=dt.date(2024, 2, 1)):
    world.land("r1", day,
               pulls=[pull("o/a", 1, "2024-01-10", "2024-01-12"), pull("o/a", 2, "2024-01-11", "2024-01-20", "2024-01-20"), pull("o/b", 1, "2024-01-15", "2024-01-15")],
               issues=[issue("o/a", 7, "2024-01-02", "2024-01-04"), issue("o/a", 8, "2024-01-05", "2024-01-30", "2024-01-30"), issue("o/b", 3, "2024-01-03", "2024-01-03")],
               reviews=[review("o/a", 1, 100, "2024-01-11"), review("o/a", 1, 101, "2024-01-12"), review("o/b", 1, 102, "2024-01-16")])
    return world.run("r1", day)


def test_days_of_an_organisation(spark, monkeypatch):
    """One history of runs: each equals the full rebuild, and each step shows what it may touch."""
    world = World(spark)
    one = first_run(world)
    assert one.new_rows == 9
    world.check(one, dt.date(2024, 2, 1))
    before = {n: files(t) for n, t in one.parts.items()}

    # a PR moves to a later updated_at day, an issue wakes up, a review arrives late, a new repo comes
    day = dt.date(2024, 2, 4)
    world.land("r2", day, pulls=[pull("o/a", 1, "2024-01-10", "2024-02-03"), pull("o/c", 1, "2024-02-02", "2024-02-02")],
               issues=[issue("o/a", 7, "2024-01-02", "2024-02-03"), issue("o/c", 1, "2024-02-02", "2024-02-02")],
               reviews=[review("o/a", 1, 100, "2024-01-11"), review("o/a", 1, 101, "2024-01-12"), review("o/a", 1, 103, "2024-02-03")])
    with monkeypatch.context() as m:
        m.setattr(daily, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):  # a run that dies before it is published
            world.run("r2", day, keep=1)
    held = daily.load(spark, world.root)
    assert held.seq == 1 and {n: t.parts for n, t in held.parts.items()} == {n: t.parts for n, t in one.parts.items()}
    two = world.run("r2", day)
    assert two.new_rows == 5  # the two reviews that the PR's change delivers again are known, the rows of the dead run are not
    world.check(two, day)
    now = {n: files(t) for n, t in two.parts.items()}
    for name, part in (("pull_versions", "2024-01-11"), ("int_pr_lifecycle", "2024-01-20"), ("fact_pr_cycle_time", "2024-01-15"), ("int_issue_lifecycle", "2024-01-30"),
                       ("fact_issue_aging", "2024-01-03"), ("int_pr_reviews_agg", "2024-01-16")):
        assert now[name][part] == before[name][part], name
    assert "2024-01-12" in before["int_pr_lifecycle"] and "2024-01-12" not in now["int_pr_lifecycle"]  # its only row moved away
    mart_before, mart_now = before["mart_repo_health_daily"], now["mart_repo_health_daily"]
    assert [p for p in mart_before if mart_now[p] == mart_before[p]]  # days of repos that nothing arrived for

    # the same rows landed again: nothing new, nothing written
    day = dt.date(2024, 2, 5)
    world.land("r3", day, pulls=[pull("o/a", 1, "2024-01-10", "2024-02-03")], issues=[issue("o/a", 7, "2024-01-02", "2024-02-03")],
               reviews=[review("o/a", 1, 103, "2024-02-03")])
    three = world.run("r3", day)
    assert three.new_rows == 0 and {n: t.parts for n, t in three.parts.items()} == {n: t.parts for n, t in two.parts.items()}
    stamped = three.plain["ingestion_cursors"].filter(F.col("updated_at") == F.lit(dt.datetime.combine(day, dt.time(12)))).count()
    assert stamped  # the cursors say when a repo was last read; the gate does not follow them

    # a repo with an earlier first day moves the calendar; versions older than two runs leave
    day = dt.date(2024, 2, 6)
    world.land("r4", day, issues=[issue("o/z", 1, "2023-12-28", "2024-02-05", "2024-01-15")])
    four = world.run("r4", day, keep=2)
    world.check(four, day)
    again = daily.load_state(spark, world.root)
    same(again["mart_repo_health_daily"], four.views()["mart_repo_health_daily"])
    log = daily._log(spark, world.root)
    marts = sorted((r for r in log if r["name"] == "mart_repo_health_daily"), key=lambda r: r["seq"])
    assert [(r["seq"], os.path.exists(local(r["path"]))) for r in marts] == [(1, False), (2, True), (4, True)]  # run 3 reads the version of run 2
    old = PartTable.load(spark, marts[1]["path"], marts[1]["description"])
    assert old.read().count() == two.parts["mart_repo_health_daily"].read().count() > 0


def test_a_run_reads_no_other_run(spark):
    """An unreadable folder of an old run does not disturb a scan of the new one."""
    world = World(spark)
    world.land("old", dt.date(2024, 1, 1), pulls=[pull("o/a", 1, "2024-01-01", "2024-01-01")])
    world.land("new", dt.date(2024, 1, 2), pulls=[pull("o/b=x:y", 2, "2024-01-02", "2024-01-02")])
    root = world.roots["pulls"]
    folders = landing.run_folders(spark, root, ["new"])
    assert len(folders) == 1 and "dt=2024-01-02" in folders[0]
    broken = local(f"{root}/dt=2024-01-01/repo=o__a/run_id=old")
    for f in os.listdir(broken):
        os.remove(f"{broken}/{f}")
    os.rmdir(broken)
    os.symlink("/nonexistent/folder", broken)
    found = landing.read_landing(spark, root, runs=["new"]).collect()
    assert [(r["repo_full_name"], str(r["dt"]), r["run_id"]) for r in found] == [("o/b=x:y", "2024-01-02", "new")]
    assert landing.read_landing(spark, root, runs=["new"], since="2024-01-03").isEmpty()
    assert landing.read_landing(spark, root, runs=["never"]).isEmpty()


def test_history_appends_closed_versions(spark):
    root = new_work_dir(spark, "t-history")
    from repo_pulse.operators import staging as stg

    def pulls(*found):
        return stg.stg_pulls(spark.createDataFrame([(dt.date(2024, 1, 1), *r) for r in found], landing.LANDING_SCHEMA))

    snaps = [pulls(pull("o/a", 1, "2024-01-01", "2024-01-01"), pull("o/a", 2, "2024-01-01", "2024-01-01")),
             pulls(pull("o/a", 1, "2024-01-01", "2024-01-03"), pull("o/a", 3, "2024-01-02", "2024-01-02")),
             pulls(pull("o/a", 1, "2024-01-01", "2024-01-05"), pull("o/a", 2, "2024-01-01", "2024-01-02"))]
    whole, kept = None, {}
    for i, snap in enumerate(snaps):
        now = dt.datetime(2024, 1, 2 + 2 * i)
        whole = hist.scd2_merge(whole, snap, now)
        open_, closed = daily.snapshot(spark, root, snap, now)
        same(daily.history(open_, closed), whole)
        found = {f: t for p in files(closed).values() for f, t in p.items()}
        assert kept.items() <= found.items()  # closed files stay as they are
        kept = found
    assert len(kept) >= 2 and open_.count() == 2
