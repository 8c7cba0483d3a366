"""

Usage: BENCH_CPUS=4 python scripts/baseline_compare.py [sf_dir]
Direct forms live only here (they are the slow shapes the library avoids).
Prints one JSON line {query: {"direct": s, "ours": s}}; median of warm runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from repo_pulse.functions import safe_bigint, safe_bool, safe_timestamp  # noqa: E402
from repo_pulse.operators import lifecycle as lc  # noqa: E402
from repo_pulse.operators import mart  # noqa: E402
from repo_pulse.operators import staging as stg  # noqa: E402
from repo_pulse.operators import upsert as up  # noqa: E402
from repo_pulse.operators.dedup import latest_version, version_order  # noqa: E402
from repo_pulse.plans import catalog  # noqa: E402
from repo_pulse.session import get_session  # noqa: E402
from repo_pulse.sources import fixtures as fx  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def timed(make):
    ts = []
    for _ in range(RUNS):
        t = time.time()
        make().write.format("noop").mode("overwrite").save()
        ts.append(time.time() - t)
    return round(statistics.median(ts[1:] if len(ts) > 1 else ts), 3)


def direct_backlog(fi, cal, stale_days=30):
    c = F.to_date("i.created_at")
    x = F.to_date("i.closed_at")
    is_open = F.col("i.created_at").isNotNull() & (c <= F.col("c.metric_date")) & (
        F.col("i.closed_at").isNull() | (x > F.col("c.metric_date")))
    stale = is_open & (F.datediff(F.col("c.metric_date"), F.to_date("i.updated_at")) > stale_days)
    return (cal.alias("c").join(fi.alias("i"), F.col("c.repo_full_name") == F.col("i.repo_full_name"), "left")
            .groupBy(F.col("c.metric_date").alias("metric_date"), F.col("c.repo_full_name").alias("repo_full_name"))
            .agg(F.count_if(is_open).alias("open_issues_count"), F.count_if(stale).alias("stale_issues_count")))


def direct_mart(fp, fi, as_of):
    bounds = mart.date_bounds(fp, fi, as_of)
    cal = mart.calendar(mart.repo_list(fp, fi), bounds)
    keys = ["metric_date", "repo_full_name"]
    return (cal.join(mart.pr_created_daily(fp), keys, "left")
            .join(mart.pr_merged_daily(fp), keys, "left")
            .join(direct_backlog(fi, cal), keys, "left"))


def get_json_pulls(raw):
    g = lambda p: F.get_json_object("payload", p)
    r = raw.filter(F.col("event_type") == "pull")
    return r.select(
        "ingestion_date", "repo_full_name", safe_bigint(g("$.number")).alias("pr_number"),
        safe_bigint(g("$.id")), g("$.node_id"), F.lower(g("$.state")), g("$.title"), safe_bool(g("$.draft")),
        g("$.html_url"), g("$.base.ref"), g("$.head.ref"), g("$.user.login"), safe_bigint(g("$.user.id")),
        *[safe_bigint(g(f"$.{c}")) for c in ["additions", "deletions", "changed_files", "comments",
                                              "review_comments", "commits"]],
        safe_timestamp(g("$.created_at")), safe_timestamp(g("$.updated_at")).alias("updated_at"),
        safe_timestamp(g("$.closed_at")), safe_timestamp(g("$.merged_at")))


def max_by_latest(parsed, keys):
    rest = [c for c in parsed.columns if c not in keys]
    order = F.struct(F.col("updated_at").isNotNull(), "updated_at", "ingestion_date", "_tie")
    return (parsed.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("v")).select(*keys, "v.*"))


def main():
    sf_dir = (sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1").rstrip("/")
    spark = get_session()
    praw, rraw = fx.pulls_raw(spark, sf_dir), fx.reviews_raw(spark, sf_dir)
    fp, fi = catalog.fact_pr(spark, sf_dir), catalog.fact_issue(spark, sf_dir)
    fp.count(), fi.count(), fx.issues_raw(spark, sf_dir).count()
    as_of = catalog.AS_OF
    out = {}
    out["mart_repo_health_daily"] = {"direct": timed(lambda: direct_mart(fp, fi, as_of)),
                                     "ours": timed(lambda: mart.mart_repo_health_daily(fp, fi, as_of))}
    bounds = mart.date_bounds(fp, fi, as_of)
    out["open_issues_daily"] = {
        "direct": timed(lambda: direct_backlog(fi, mart.calendar(mart.repo_list(fp, fi), bounds))),
        "ours": timed(lambda: mart.issue_backlog_daily(fi, mart.calendar(mart.repo_list(fp, fi), bounds), bounds))}
    out["stg_pulls_parse"] = {"direct": timed(lambda: get_json_pulls(praw)),
                              "ours": timed(lambda: stg.parse_pulls(praw))}
    parsed = stg.parse_reviews(rraw).filter(F.col("review_id").isNotNull())
    out["latest_version"] = {"direct": timed(lambda: max_by_latest(parsed, up.REVIEW_KEY)),
                             "ours": timed(lambda: latest_version(parsed, up.REVIEW_KEY, version_order()))}
    pb1, _ = catalog._split(praw)
    target = up.commit_version(stg.stg_pulls(pb1), "bl_target")
    pp = stg.parse_pulls(praw).filter(F.col("pr_number").isNotNull())
    out["lookback_filter_dedup"] = {
        "direct": timed(lambda: up.lookback_filter(latest_version(pp, up.PULL_KEY, version_order()), target)),
        "ours": timed(lambda: latest_version(up.lookback_filter(pp, target), up.PULL_KEY, version_order()))}
    s = catalog._incremental(spark, sf_dir)
    out["reviews_agg_incremental"] = {
        "direct": timed(lambda: lc.reviews_agg(stg.stg_reviews(rraw))),
        "ours": timed(lambda: up.reviews_agg_incremental(s["agg_1"], s["stg_reviews_2"], s["changed_by_reviews"]))}
    print(json.dumps({"sf_dir": sf_dir, "cpus": os.environ.get("BENCH_CPUS", "8"), "results": out}))
    spark.stop()


if __name__ == "__main__":
    main()
