"""The daily run on tables that outlive the process; its cost follows the arrivals.

``run_daily`` takes the landed rows past the cursors, drops those that the raw
tables hold already (the boundary row that an inclusive cursor delivers again
and again), appends the rest and, if any are left (the gate), refreshes what
they touch:

* latest versions, review aggregate, lifecycles and facts are ``PartTable``s:
  only partitions with an arrived key, before or after, are written;
* ages and stale flags of issues depend on the day, not on arrivals, so they are
  computed on read against the day of the run;
* the mart is maintained by differences (``mart_delta``).

A run is published by one write to a log: a row per table with the manifest it
reads. Whatever died before that write is not part of any table, raw rows
included, and the next run takes its rows again. ``keep`` old versions stay
readable; what only older ones name is deleted after the log is written.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from repo_pulse.functions import safe_timestamp
from repo_pulse.operators import history as hist
from repo_pulse.operators import lifecycle as lc
from repo_pulse.operators import mart_delta as md
from repo_pulse.operators import quality as dq
from repo_pulse.operators import quality_state as qs
from repo_pulse.operators import staging as stg
from repo_pulse.operators.dedup import latest_version, version_order
from repo_pulse.operators.part_table import NO_PART, PartTable, day_of, part_of_day
from repo_pulse.operators.upsert import ISSUE_KEY, PULL_KEY, REVIEW_KEY, commit_version, matching, reviews_agg_of
from repo_pulse.plans.job import CURSOR_SCHEMA, ENTITIES, _feed
from repo_pulse.session import delete
from repo_pulse.sources import cursors as cur
from repo_pulse.sources import landing

LOG_SCHEMA = "seq long, name string, path string, description string, as_of date, first_day date"
RAW_KEY = {"pulls": ["repo_full_name"], "issues": ["repo_full_name"], "pr_reviews": ["repo_full_name", "pr_number"]}
# name: (key, timestamp or date that places a row, clustering)
LAYOUT = {
    "raw_pulls": (None, "ingestion_date", ()),
    "raw_issues": (None, "ingestion_date", ()),
    "raw_pr_reviews": (None, "ingestion_date", ()),
    "pull_versions": (PULL_KEY, "created_at", ("repo_full_name",)),
    "issue_versions": (ISSUE_KEY, "created_at", ("repo_full_name",)),
    "review_versions": (REVIEW_KEY, "updated_at", ("repo_full_name",)),
    "int_pr_reviews_agg": (PULL_KEY, "updated_at", ("repo_full_name",)),
    "int_pr_lifecycle": (PULL_KEY, "updated_at", ("repo_full_name", "pull_request_state")),
    "int_issue_lifecycle": (ISSUE_KEY, "updated_at", ("repo_full_name", "issue_state")),
    "fact_pr_cycle_time": (PULL_KEY, "created_date", ("repo_full_name", "pull_request_state")),
    "fact_issue_aging": (ISSUE_KEY, "created_date", ("repo_full_name", "issue_state")),
    "mart_sums": (md.KEY, None, ("repo_full_name",)),
    "mart_repo_health_daily": (md.KEY, None, ("repo_full_name",)),
}


@dataclass
class Tables:
    """The tables of one run: partitioned ones by name, and plain ones by path."""

    parts: dict[str, PartTable] = field(default_factory=dict)
    plain: dict[str, DataFrame] = field(default_factory=dict)
    as_of: dt.date | None = None
    first_day: dt.date | None = None
    seq: int = 0
    new_rows: int = 0  # the gate: rows new to the raw tables
    changed_prs: DataFrame | None = None  # keys of the PRs that the run refreshed, or whose reviews it did

    def checked(self, stale_days: int = lc.DEFAULT_STALE_DAYS) -> dict[str, qs.Source]:
        """The tables of the quality report, each with its row-wise view."""
        def reviews(df: DataFrame, as_of: dt.date) -> DataFrame:
            return df.filter(F.col("pr_number").isNotNull())

        def aged(df: DataFrame, as_of: dt.date) -> DataFrame:
            return lc.issue_lifecycle(df, as_of, stale_days)

        stored = {"stg_pulls": "pull_versions", "stg_issues": "issue_versions", "stg_reviews": "review_versions"}
        views = {"stg_reviews": (reviews,), "int_issue_lifecycle": (aged,), "fact_issue_aging": (lambda df, as_of: lc.fact_issue_aging(aged(df, as_of)),)}
        found = {n: stored.get(n, n) for n in dq.UNIQUE_KEYS}
        return {n: qs.Source(self.parts[t], *views.get(n, ())) for n, t in found.items() if t in self.parts}

    def views(self, stale_days: int = lc.DEFAULT_STALE_DAYS) -> dict[str, DataFrame]:
        """Every table as a DataFrame; staging is a projection of the versions, ages follow the run's day."""
        out = dict(self.plain)
        out |= {n: t.read() for n, t in self.parts.items()}
        if "pull_versions" in out:
            out["stg_pulls"], out["stg_issues"] = out["pull_versions"].drop("_tie"), out["issue_versions"].drop("_tie")
            out["stg_reviews"] = out["review_versions"].filter(F.col("pr_number").isNotNull()).drop("_tie")
            out["int_issue_lifecycle"] = lc.issue_lifecycle(out["int_issue_lifecycle"], self.as_of, stale_days)
            out["fact_issue_aging"] = lc.fact_issue_aging(lc.issue_lifecycle(out["fact_issue_aging"], self.as_of, stale_days))
        return out


# ---------------------------------------------------------------- transform


def mart_unit(unit: str) -> str:
    """Mart rows are few a day (one a repo): days would make small files."""
    return "month" if unit == "day" else unit


def _table(tables: Tables, name: str, like: DataFrame, root: str, unit: str, buckets: int = md.BUCKETS) -> PartTable:
    """The table of the run before, or an empty one with the columns of ``like``."""
    if name in tables.parts:
        return tables.parts[name]
    _, column, cluster = LAYOUT[name]
    part = day_of(column, unit) if column else md.bucket_part(mart_unit(unit), buckets)
    return PartTable(like.sparkSession, f"{root}/{name}", like.schema, part, cluster)


def _stored(df: DataFrame, name: str, at: str | None = None) -> DataFrame:
    """Rows of the arrived keys, kept for the steps that follow."""
    return commit_version(df, f"arrived_{name}", at=at)


def first_created(tables: Sequence[PartTable], as_of: dt.date) -> dt.date:
    """The first created day of the facts, at most ``as_of``; reads the first partition of each."""
    found = []
    for t in tables:
        dated = [p for p in t.parts if p != NO_PART]
        if dated:
            found.append(t.read([min(dated)]).agg(F.min(F.to_date("created_at")).alias("d")).first()["d"])
    return min([as_of, *(d for d in found if d)])


def transform_touched(before: Tables, new_raw: Mapping[str, DataFrame], root: str, as_of: dt.date,
                      stale_days: int = lc.DEFAULT_STALE_DAYS, unit: str = "day", buckets: int = md.BUCKETS) -> Tables:
    """The tables after the raw rows ``new_raw``; equals a full rebuild over all raw rows so far."""
    if before.as_of and as_of < before.as_of:
        raise ValueError(f"the run before was for {before.as_of}; {as_of} is earlier")
    out = Tables({n: t for n, t in before.parts.items()}, dict(before.plain), as_of, before.first_day, before.seq, before.new_rows)

    few = unit == "year"
    passing = f"{root}/passing-{uuid.uuid4().hex[:12]}"  # rows that only this function reads

    def first(name: str, rows: DataFrame) -> DataFrame:
        """The rows of a table without any before: written once, to the table, and read there."""
        out.parts[name] = _table(before, name, rows, root, unit).appended(rows, few)
        return out.parts[name].read()

    def is_first(name: str) -> bool:
        return not (name in before.parts and before.parts[name].parts)

    def versions(name: str, parsed: DataFrame, with_old: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Merge arrived versions; (keys, columns ``with_old`` of their rows before, arrived rows)."""
        key = LAYOUT[name][0]
        arrived = latest_version(parsed.filter(F.col(key[-1]).isNotNull()), key, version_order())
        if is_first(name):
            arrived = first(name, arrived)
            return arrived.select(*key), arrived.select(*with_old).limit(0), arrived
        arrived = _stored(arrived, f"{name}_arrived", passing)  # parsed once
        table = before.parts[name]
        keys = arrived.select(*key)
        columns = list(dict.fromkeys([*key, *with_old]))
        old = matching(table.read().select(*columns, table._part().alias("_part")), keys, key)
        old = _stored(old, f"{name}_old", passing)
        places = [r["_part"] for r in old.select("_part").distinct().collect()]  # one row a partition
        merge = lambda held: latest_version(held.unionByName(arrived), key, version_order())  # noqa: E731  one row a key on both sides
        out.parts[name] = table.remade(places, table.places_of(arrived), merge)
        return keys, old.select(*with_old), arrived

    def rows_of(name: str, keys: DataFrame, key: Sequence[str]) -> DataFrame:
        """Rows of changed keys; all rows of a table that the run made, as each came from a changed key."""
        return out.parts[name].read() if is_first(name) else out.parts[name].rows_of(keys, key)

    def refresh(name: str, keys: DataFrame, now: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Merge recomputed rows of ``keys``; (their rows before, their rows now)."""
        key = LAYOUT[name][0]
        if is_first(name):
            now = first(name, now)
            return now.limit(0), now
        now, table = _stored(now, name, passing), before.parts[name]
        places = table.holding(keys, key)
        fresh = now.select(*table.schema.fieldNames())
        out.parts[name] = table.remade(places, table.places_of(now), lambda held: matching(held, keys, key, "left_anti").unionByName(fresh))
        return matching(table.read(places), keys, key), now

    prs, _, _ = versions("pull_versions", stg.parse_pulls(new_raw["pulls"]))
    issues, _, _ = versions("issue_versions", stg.parse_issues(new_raw["issues"]))
    _, old_reviews, new_reviews = versions("review_versions", stg.parse_reviews(new_raw["pr_reviews"]), PULL_KEY)

    reviewed = old_reviews.select(*PULL_KEY).union(new_reviews.select(*PULL_KEY)).filter(F.col("pr_number").isNotNull())
    reviewed = _stored(reviewed.distinct(), "reviewed_prs", passing)
    reviews = out.parts["review_versions"]
    if is_first("review_versions"):
        counts = lc.reviews_agg(reviews.read().filter(F.col("pr_number").isNotNull()))
    else:
        counts = reviews_agg_of(reviews.around(reviewed, PULL_KEY), reviewed)
    refresh("int_pr_reviews_agg", reviewed, counts)
    out.changed_prs = prs = _stored(prs.union(reviewed).distinct(), "changed_prs")
    pulls, agg = (rows_of(n, prs, PULL_KEY) for n in ("pull_versions", "int_pr_reviews_agg"))
    matched = not (is_first("pull_versions") or is_first("int_pr_reviews_agg"))
    _, life = refresh("int_pr_lifecycle", prs, lc.pr_lifecycle(pulls, agg, matched=matched))
    old_pr, new_pr = refresh("fact_pr_cycle_time", prs, lc.fact_pr_cycle_time(life))
    issue_rows = rows_of("issue_versions", issues, ISSUE_KEY)
    _, life = refresh("int_issue_lifecycle", issues, lc.issue_lifecycle(issue_rows, as_of, stale_days))
    old_issue, new_issue = refresh("fact_issue_aging", issues, lc.fact_issue_aging(life))

    change = _stored(md.changes(md.contributions(old_pr, old_issue, stale_days), md.contributions(new_pr, new_issue, stale_days)), "mart_change")
    repos = new_pr.select("repo_full_name").union(new_issue.select("repo_full_name")).distinct()
    refresh_mart(before, out, change, repos, root, unit, buckets)
    delete(prs.sparkSession, passing)
    return out


def refresh_mart(before: Tables, out: Tables, change: DataFrame, arrived_repos: DataFrame, root: str, unit: str, buckets: int) -> None:
    """M8 by differences: only affected repos and days are computed, and the calendar grows to the run's day."""
    sums = _table(before, "mart_sums", change, root, unit, buckets)
    now = _stored(md.added(sums.rows_of(change, md.KEY), change), "mart_sums")
    out.parts["mart_sums"] = sums = sums.merged(change, now, md.KEY, places=())
    first = first_created([out.parts["fact_pr_cycle_time"], out.parts["fact_issue_aging"]], out.as_of)
    old = before.parts.get("mart_repo_health_daily")
    whole = old is None or first != before.first_day  # the calendar of every repo moves
    since = first if whole else before.as_of + dt.timedelta(days=1)
    if old is None:
        known = arrived_repos.limit(0)
    else:
        last = part_of_day(before.as_of, mart_unit(unit))
        known = old.between(last, f"{last}.~").filter(F.col("metric_date") == F.lit(before.as_of)).select("repo_full_name")
    new = matching(arrived_repos, known, ["repo_full_name"], "left_anti").select("repo_full_name", F.lit(True).alias("is_new"))
    repos = known.select("repo_full_name", F.lit(whole).alias("is_new")).unionByName(new)
    start = _stored(md.starts(repos, change, first, since), "mart_starts")
    low = start.agg(F.min("start").alias("d")).first()["d"] or first
    if old is None or whole:
        carried = sums.read([]).select("repo_full_name", "metric_date", F.lit(0).alias("open_issues_count"), F.lit(0).alias("stale_issues_count"))
    else:
        carried = old.between(part_of_day(low - dt.timedelta(days=1), mart_unit(unit)))
    rows = md.rows_from(start, sums.between(part_of_day(low, mart_unit(unit))), carried, out.as_of)
    rows = _stored(rows, "mart_rows")
    table = _table(before, "mart_repo_health_daily", rows, root, unit, buckets)
    if whole:
        places = set(table.parts) | {r["p"] for r in rows.select(F.expr(table.part).alias("p")).distinct().collect()}  # one row a partition
        out.parts["mart_repo_health_daily"] = table.replaced(places, rows)
    else:
        out.parts["mart_repo_health_daily"] = table.merged(rows, rows, md.KEY, places=())
    out.first_day = first


# ---------------------------------------------------------------- ingest


def new_to_raw(arrived: DataFrame, raw: PartTable, keys: Sequence[str], at: str) -> DataFrame:
    """Arrived rows whose (repo, number, payload) the raw table does not hold.

    ``at``: the rows' own time; a row can't have been loaded before it was
    written, so only raw days from the earliest one on (less a day for clocks)
    are read; all if a row has no time.
    """
    low = arrived.agg(F.min(F.to_date(at)).alias("d"), F.count_if(F.col(at).isNull()).alias("n")).first()
    held = raw.between(None if low["n"] or low["d"] is None else (low["d"] - dt.timedelta(days=1)).isoformat())
    keys = [*keys, "_payload"]
    hashed = arrived.withColumn("_payload", F.md5("payload"))
    return matching(hashed, held.withColumn("_payload", F.md5("payload")), keys, "left_anti").drop("_payload")


def ingest(spark: SparkSession, landing_roots: Mapping[str, str], tables: Tables, raw_paths: Mapping[str, str], now: dt.datetime,
           first_run: str = "full", runs: Sequence[str] | None = None, at: str | None = None) -> tuple[DataFrame, dict[str, DataFrame], dict[str, PartTable]]:
    """(advanced cursors, rows new to raw, raw tables with them)."""
    def landed(entity: str, with_pr_number: bool = False) -> DataFrame:
        return landing.read_landing(spark, landing_roots[entity], with_pr_number, runs)

    cursors = tables.plain.get("ingestion_cursors")
    cursors = spark.createDataFrame([], CURSOR_SCHEMA) if cursors is None else cursors
    pulls, issues = _feed(landed("pulls"), "pr_number"), _feed(landed("issues"), "issue_number", drop_pull_requests=True)
    for_reviews = cur.changed_feed(pulls, cursors, "pr_reviews", now, first_run)
    written = F.from_json("payload", "submitted_at string, updated_at string, created_at string")
    reviews = landed("pr_reviews", True).withColumn("_t", written)
    reviews = reviews.withColumn("updated_at", F.coalesce(*[safe_timestamp(F.col(f"_t.{c}")) for c in ("submitted_at", "updated_at", "created_at")]))
    changed = {"pulls": cur.changed_feed(pulls, cursors, "pulls", now, first_run), "issues": cur.changed_feed(issues, cursors, "issues", now, first_run),
               "pr_reviews": cur.reviews_of_changed_prs(reviews, for_reviews)}
    rows, raw = {}, {}
    for entity in ENTITIES:
        columns = [c.split()[0] for c in (landing.REVIEW_LANDING_SCHEMA if entity == "pr_reviews" else landing.LANDING_SCHEMA).split(", ")]
        arrived = _stored(changed[entity].select(*columns, "updated_at"), entity)
        like = arrived.select(*columns)
        table = tables.parts.get(f"raw_{entity}") or PartTable(spark, raw_paths[entity], like.schema, day_of("ingestion_date"))
        rows[entity] = _stored(new_to_raw(arrived, table, RAW_KEY[entity], "updated_at").select(*columns), f"{entity}_new")
        raw[f"raw_{entity}"] = table.appended(rows[entity])
    marks = (cur.watermark_max(changed["pulls"], "pulls").unionByName(cur.watermark_max(changed["issues"], "issues"))
             .unionByName(cur.watermark_max(for_reviews, "pr_reviews")))
    return commit_version(cur.cursor_upsert(cursors, marks, now), "ingestion_cursors", at=at), rows, raw


# ---------------------------------------------------------------- log


def _log(spark: SparkSession, root: str) -> list:
    """All log rows, a dozen a run, newest run last; none before the first run."""
    try:
        return sorted(spark.read.schema(LOG_SCHEMA).parquet(f"{root}/log").collect(), key=lambda r: (r["seq"], r["name"]))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def load(spark: SparkSession, root: str, log: list | None = None) -> Tables:
    """The current tables under ``root``; none before the first run."""
    newest = {r["name"]: r for r in (_log(spark, root) if log is None else log)}
    out = Tables()
    for name, r in newest.items():
        if _partitioned(r):
            out.parts[name] = PartTable.load(spark, r["path"], r["description"])
        else:
            out.plain[name] = spark.read.schema(StructType.fromJson(json.loads(r["description"]))).parquet(r["path"])
    if newest:
        last = max(newest.values(), key=lambda r: r["seq"])
        out.seq, out.as_of, out.first_day = last["seq"], last["as_of"], last["first_day"]
    return out


def _partitioned(row) -> bool:
    return "part" in json.loads(row["description"])


def load_state(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The current tables under ``root`` as DataFrames by name."""
    return load(spark, root).views()


def _publish(spark: SparkSession, root: str, before: Tables, now: Tables, at: str) -> None:
    """One write makes all tables of the run current together."""
    rows = [(now.seq, n, t.save(), t.describe(), now.as_of, now.first_day) for n, t in now.parts.items() if t is not before.parts.get(n)]
    rows += [(now.seq, n, f"{at}/{n}", df.schema.json(), now.as_of, now.first_day) for n, df in now.plain.items() if df is not before.plain.get(n)]
    spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/log")


def retire(spark: SparkSession, root: str, keep: int) -> int:
    """Delete folders that no table of the last ``keep`` runs names; how many went. Raw tables stay whole."""
    log = _log(spark, root)
    runs = sorted({r["seq"] for r in log})
    if keep < 1 or len(runs) <= keep:
        return 0
    first = runs[-keep]
    gone = 0
    for name in {r["name"] for r in log} - {n for n in LAYOUT if n.startswith("raw_")}:
        rows = [r for r in log if r["name"] == name]
        oldest = max((r["seq"] for r in rows if r["seq"] <= first), default=first)  # what the first kept run reads
        kept = [r for r in rows if r["seq"] >= oldest]
        for r in rows:
            if r["seq"] < oldest:
                gone += _drop(spark, r, kept)
    return gone


def _drop(spark: SparkSession, row, kept: list) -> int:
    """Delete one older version of a table, but for the folders that kept ones share."""
    gone = 0
    if _partitioned(row):
        try:
            gone = PartTable.load(spark, row["path"], row["description"]).retire([PartTable.load(spark, k["path"], k["description"]) for k in kept])
        except AnalysisException as e:  # its manifest went with an earlier run
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0
    return gone + delete(spark, row["path"])


# ---------------------------------------------------------------- run


def run_daily(spark: SparkSession, landing_roots: Mapping[str, str], raw_paths: Mapping[str, str], root: str, as_of: dt.date,
              now: dt.datetime, runs: Sequence[str] | None = None, first_run: str = "full", stale_days: int = lc.DEFAULT_STALE_DAYS,
              unit: str = "day", keep: int | None = None, buckets: int = md.BUCKETS) -> Tables:
    """Ingest, gate, transform and quality report on the tables under ``root``; one run at a time.

    ``unit``: partitions of a day, month or year (mart: month or year, within
    ``buckets`` of repos; both are fixed by the first run); ``keep``: runs whose tables stay
    readable (default: all). Without rows new to raw only the cursors move.
    """
    before = load(spark, root)
    at = f"{root}/run-{uuid.uuid4().hex[:12]}"
    new_cursors, rows, raw = ingest(spark, landing_roots, before, raw_paths, now, first_run, runs, at)
    n = sum(df.count() for df in rows.values())
    if n:
        after = transform_touched(before, rows, root, as_of, stale_days, unit, buckets)
        after.parts |= raw
        counts, keys = qs.update(spark, before.plain.get("dq_counts"), before.parts.get("dq_keys"), before.checked(stale_days), after.checked(stale_days), as_of,
                                 f"{root}/dq_keys", lambda df, name: commit_version(df, name, at=at), after.changed_prs)
        after.plain["dq_counts"], after.parts["dq_keys"] = counts, keys
        after.plain["dq_report"] = commit_version(qs.report(spark, counts, after.checked(), as_of), "dq_report", at=at)
    else:
        after = Tables(dict(before.parts), dict(before.plain), before.as_of, before.first_day)
    after.seq, after.new_rows = before.seq + 1, n
    after.plain["ingestion_cursors"] = new_cursors
    _publish(spark, root, before, after, at)
    if keep:
        retire(spark, root, keep)
    return after


# ---------------------------------------------------------------- history


def snapshot(spark: SparkSession, root: str, stg_pulls: DataFrame, now: dt.datetime) -> tuple[DataFrame, PartTable]:
    """H1 with open and closed versions apart: (open versions, closed versions) under ``root``/pr_state_history.

    The open part has one row a key and is written anew; closed versions are
    appended, partitioned by the day they closed, and never read again but for
    the last close of keys that come back.
    """
    log = [r for r in _log(spark, f"{root}/pr_state_history")]
    state = load(spark, f"{root}/pr_state_history", log)
    at = f"{root}/pr_state_history/open-{uuid.uuid4().hex[:12]}"
    open_ = state.plain.get("open")
    fresh = hist.as_versions(stg_pulls)
    if open_ is None:
        closed = PartTable(spark, f"{root}/pr_state_history/closed", fresh.schema, day_of("valid_to"), ("snapshot_key",))
        step = _stored(fresh, "history")
    else:
        closed = state.parts["closed"]
        step = _stored(hist.scd2_step(open_, closed.read(), stg_pulls, now), "history")
    after = Tables({"closed": closed.appended(step.filter(F.col("valid_to").isNotNull()))}, {}, seq=state.seq + 1)
    after.plain["open"] = commit_version(step.filter(F.col("valid_to").isNull()), "open", at=at)
    _publish(spark, f"{root}/pr_state_history", Tables(), after, at)
    return after.plain["open"], after.parts["closed"]


def history(open_: DataFrame, closed: PartTable) -> DataFrame:
    """The whole history, as ``scd2_merge`` gives it."""
    return closed.read().unionByName(open_)
