"""Orchestrated batch run: ingest -> gate -> transform -> quality; history apart.

``run_batch`` is the whole daily cycle as Spark jobs over landed files:

1. ingest: scan each entity's landing zone, keep rows changed since the
   per-repo cursor (reviews: all reviews of changed PRs), append them to the
   raw tables, advance the cursors (only where a maximum exists);
2. gate: count cursors advanced since the run started (one number);
3. transform: every model written once, as a new table version, in
   dependency order (staging is persisted once and read by all consumers);
   given the tables of the run before, only keys that arrived are recomputed;
4. quality: the full check report, written next to the models.

``daily.run_daily`` does the same with tables that outlive the process.

``snapshot`` merges the current staging pulls into the SCD2 history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repo_pulse.functions import safe_bigint, safe_timestamp
from repo_pulse.operators import history as hist
from repo_pulse.operators import lifecycle as lc
from repo_pulse.operators import mart
from repo_pulse.operators import quality as dq
from repo_pulse.operators import staging as stg
from repo_pulse.operators import upsert as up
from repo_pulse.operators.upsert import commit_version
from repo_pulse.session import delete, new_work_dir
from repo_pulse.sources import cursors as cur
from repo_pulse.sources import landing

ENTITIES = ("pulls", "issues", "pr_reviews")
CURSOR_SCHEMA = ("entity string, repo_full_name string, last_updated_at timestamp, "
                 "last_success_run timestamp, updated_at timestamp")


def _feed(land: DataFrame, key: str, drop_pull_requests: bool = False) -> DataFrame:
    """Landed rows with their entity key and ``updated_at`` parsed (two fields only)."""
    j = F.from_json("payload", "number string, updated_at string, pull_request variant")
    out = land.select("*", j.alias("_k"))
    if drop_pull_requests:  # S9: the issues endpoint also returns PRs
        out = out.filter(F.col("_k.pull_request").isNull())
    return out.select(*land.columns, safe_bigint(F.col("_k.number")).alias(key),
                      safe_timestamp(F.col("_k.updated_at")).alias("updated_at"))


def ingest(spark: SparkSession, landing_roots: Mapping[str, str], raw_paths: Mapping[str, str],
           cursors: DataFrame, now: dt.datetime, first_run: str = "full", runs: Sequence[str] | None = None) -> DataFrame:
    """Step 1: landing -> raw (changed rows only); returns the advanced cursor table.

    ``first_run`` says what a repo without a cursor loads ("full", or
    "lookback" for the last days only); ``runs`` reads only those run folders.
    """
    return _ingest(spark, landing_roots, raw_paths, cursors, now, first_run, runs)[0]


def _ingest(spark, landing_roots, raw_paths, cursors, now, first_run, runs, at=None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The advanced cursors, and the rows that this run appended to each raw table (stored)."""
    def landed(entity: str, with_pr_number: bool = False) -> DataFrame:
        return landing.read_landing(spark, landing_roots[entity], with_pr_number, runs)

    pulls = _feed(landed("pulls"), "pr_number")
    issues = _feed(landed("issues"), "issue_number", drop_pull_requests=True)
    reviews = landed("pr_reviews", with_pr_number=True)
    env = ["ingestion_date", "repo_full_name", "event_type", "payload"]

    p_changed = cur.changed_feed(pulls, cursors, "pulls", now, first_run)
    i_changed = cur.changed_feed(issues, cursors, "issues", now, first_run)
    prs_for_reviews = cur.changed_feed(pulls, cursors, "pr_reviews", now, first_run)
    r_changed = cur.reviews_of_changed_prs(reviews, prs_for_reviews)

    new_raw = {
        "pulls": commit_version(p_changed.select(*env), "arrived_pulls"),
        "issues": commit_version(i_changed.select(*env), "arrived_issues"),
        "pr_reviews": commit_version(r_changed.select("ingestion_date", "repo_full_name", "pr_number", "event_type", "payload"),
                                     "arrived_reviews"),
    }
    for entity, rows in new_raw.items():
        landing.append_raw(rows, raw_paths[entity])
    marks = (cur.watermark_max(p_changed, "pulls")
             .unionByName(cur.watermark_max(i_changed, "issues"))
             .unionByName(cur.watermark_max(prs_for_reviews, "pr_reviews")))
    return commit_version(cur.cursor_upsert(cursors, marks, now), "ingestion_cursors", at=at), new_raw


def transform(spark: SparkSession, raw_paths: Mapping[str, str], as_of: dt.date,
              stale_days: int = lc.DEFAULT_STALE_DAYS) -> dict[str, DataFrame]:
    """Step 3: every model once, each read back from its stored version."""
    t: dict[str, DataFrame] = {}
    t["stg_pulls"] = commit_version(stg.stg_pulls(spark.read.parquet(raw_paths["pulls"])), "stg_pulls")
    t["stg_issues"] = commit_version(stg.stg_issues(spark.read.parquet(raw_paths["issues"])), "stg_issues")
    t["stg_reviews"] = commit_version(stg.stg_reviews(spark.read.parquet(raw_paths["pr_reviews"])), "stg_reviews")
    t["int_pr_reviews_agg"] = commit_version(lc.reviews_agg(t["stg_reviews"]), "int_pr_reviews_agg")
    t["int_pr_lifecycle"] = commit_version(lc.pr_lifecycle(t["stg_pulls"], t["int_pr_reviews_agg"]),
                                           "int_pr_lifecycle", cluster_by=["repo_full_name", "pull_request_state"])
    t["int_issue_lifecycle"] = commit_version(lc.issue_lifecycle(t["stg_issues"], as_of, stale_days),
                                              "int_issue_lifecycle", cluster_by=["repo_full_name", "issue_state"])
    t["fact_pr_cycle_time"] = commit_version(lc.fact_pr_cycle_time(t["int_pr_lifecycle"]), "fact_pr_cycle_time",
                                             partition_by=["created_date"],
                                             cluster_by=["repo_full_name", "pull_request_state"])
    t["fact_issue_aging"] = commit_version(lc.fact_issue_aging(t["int_issue_lifecycle"]), "fact_issue_aging",
                                           partition_by=["created_date"],
                                           cluster_by=["repo_full_name", "issue_state"])
    t["mart_repo_health_daily"] = commit_version(
        mart.mart_repo_health_daily(t["fact_pr_cycle_time"], t["fact_issue_aging"], as_of, stale_days),
        "mart_repo_health_daily", cluster_by=["repo_full_name"])
    return t


def transform_incremental(new_raw: Mapping[str, DataFrame], as_of: dt.date, state: Mapping[str, DataFrame] | None = None,
                          stale_days: int = lc.DEFAULT_STALE_DAYS,
                          fact_partitions: Sequence[str] | None = ("created_date",), at: str | None = None) -> dict[str, DataFrame]:
    """Step 3 from the rows that arrived and the tables of the run before (none: first run).

    Only keys that arrived, and PRs whose reviews did, are recomputed; the
    result equals ``transform`` over all raw rows. ``pull_versions``,
    ``issue_versions`` and ``review_versions`` are the latest versions with
    the hash that settles ties against later arrivals. ``fact_partitions``:
    None writes the facts unpartitioned (small tables over many days). ``at``:
    a folder for the tables.
    """
    def commit(df: DataFrame, name: str, **layout) -> DataFrame:
        return commit_version(df, name, at=at, **layout)

    pr_layout, issue_layout = {"cluster_by": ["repo_full_name", "pull_request_state"]}, {"cluster_by": ["repo_full_name", "issue_state"]}
    t: dict[str, DataFrame] = {}
    changed: dict[str, DataFrame] = {}
    spark = new_raw["pulls"].sparkSession
    arrived = new_work_dir(spark, "arrived")  # rows that only the merges of versions read
    for name, parse, key, update, raw in (("pull_versions", stg.parse_pulls, up.PULL_KEY, up.pull_versions_update, "pulls"),
                                          ("issue_versions", stg.parse_issues, up.ISSUE_KEY, up.issue_versions_update, "issues"),
                                          ("review_versions", stg.parse_reviews, up.REVIEW_KEY, up.review_versions_update, "pr_reviews")):
        if state:
            table, keys = update(state[name], new_raw[raw], arrived)
            t[name], changed[raw] = commit(table, name), commit_version(keys, f"changed_{raw}")
        else:  # no row to merge with: every key arrived
            t[name] = commit(up.first_versions(parse(new_raw[raw]), key), name)
    delete(spark, arrived)
    t["stg_pulls"], t["stg_issues"] = t["pull_versions"].drop("_tie"), t["issue_versions"].drop("_tie")
    t["stg_reviews"] = t["review_versions"].filter(F.col("pr_number").isNotNull()).drop("_tie")
    if state:
        agg = up.reviews_agg_incremental(state["int_pr_reviews_agg"], t["stg_reviews"], changed["pr_reviews"])
    else:
        agg = lc.reviews_agg(t["stg_reviews"])
    t["int_pr_reviews_agg"] = commit(agg, "int_pr_reviews_agg", cluster_by=["repo_full_name"])
    if state:
        prs = commit_version(changed["pulls"].select(*up.PULL_KEY).union(changed["pr_reviews"].select(*up.PULL_KEY)).distinct(), "changed_prs")
        # stored: the lifecycle and the fact both take these rows over
        fresh = commit_version(up.pr_lifecycle_of(t["stg_pulls"], t["int_pr_reviews_agg"], prs), "fresh_pr_lifecycle")
        life = up.pr_lifecycle_merged(state["int_pr_lifecycle"], fresh, prs)
    else:
        life = lc.pr_lifecycle(t["stg_pulls"], t["int_pr_reviews_agg"])
    t["int_pr_lifecycle"] = commit(life, "int_pr_lifecycle", **pr_layout)
    t["int_issue_lifecycle"] = commit(
        up.issue_lifecycle_incremental(state["int_issue_lifecycle"], t["stg_issues"], changed["issues"], as_of, stale_days) if state
        else lc.issue_lifecycle(t["stg_issues"], as_of, stale_days), "int_issue_lifecycle", **issue_layout)
    t["fact_pr_cycle_time"] = commit(
        up.fact_pr_incremental(state["fact_pr_cycle_time"], fresh, prs) if state
        else lc.fact_pr_cycle_time(t["int_pr_lifecycle"]), "fact_pr_cycle_time", partition_by=fact_partitions, **pr_layout)
    t["fact_issue_aging"] = commit(
        up.fact_issue_incremental(state["fact_issue_aging"], t["int_issue_lifecycle"], changed["issues"], as_of, stale_days) if state
        else lc.fact_issue_aging(t["int_issue_lifecycle"]), "fact_issue_aging", partition_by=fact_partitions, **issue_layout)
    t["mart_repo_health_daily"] = commit(
        mart.mart_repo_health_daily(t["fact_pr_cycle_time"], t["fact_issue_aging"], as_of, stale_days),
        "mart_repo_health_daily", cluster_by=["repo_full_name"])
    return t


def run_batch(spark: SparkSession, landing_roots: Mapping[str, str], raw_paths: Mapping[str, str],
              cursors: DataFrame, as_of: dt.date, now: dt.datetime, run_start: dt.datetime,
              repos: Sequence[str] | None = None, first_run: str = "full",
              runs: Sequence[str] | None = None, state: Mapping[str, DataFrame] | None = None,
              fact_partitions: Sequence[str] | None = ("created_date",), at: str | None = None) -> dict[str, DataFrame]:
    """Steps 1-4. Without new data (gate count 0) the transform is skipped.

    ``state``: what the run before returned ({} for the first) makes the
    transform incremental; without it every model is rebuilt from all raw rows.
    """
    new_cursors, new_raw = _ingest(spark, landing_roots, raw_paths, cursors, now, first_run, runs, at)
    gate = cur.new_data_gate(new_cursors, ENTITIES, run_start, repos).first()["updated_cursor_count"]
    out: dict[str, DataFrame] = {**(state or {}), "ingestion_cursors": new_cursors}
    if gate == 0:
        return out
    out.update(transform(spark, raw_paths, as_of) if state is None
               else transform_incremental(new_raw, as_of, state if "pull_versions" in state else None,
                                          fact_partitions=fact_partitions, at=at))
    out["dq_report"] = commit_version(dq.report(out, dt.datetime.combine(as_of, dt.time())), "dq_report", at=at)
    return out


def snapshot(history: DataFrame | None, stg_pulls: DataFrame, now: dt.datetime) -> DataFrame:
    """Merge the current staging pulls into the PR state history (new version)."""
    return commit_version(hist.scd2_merge(history, stg_pulls, now), "pr_state_history")
