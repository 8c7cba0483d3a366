"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is fully executed with the ``noop`` sink (no collect to the
driver). The raw tables are built once per session (ingest) and timed
separately. Staging and history queries, and ``mart_from_raw``, which is the
whole chain in one plan, start from the raw tables; queries over models read
the models that their first, discarded run stored, so they time one step.
The reported value is the sum of the per-query medians of warm runs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from repo_pulse.plans import catalog  # noqa: E402
from repo_pulse.session import get_session  # noqa: E402
from repo_pulse.sources import fixtures as fx  # noqa: E402

HEADLINE = [
    "stg_pulls",
    "stg_issues",
    "stg_reviews",
    "int_pr_reviews_agg",
    "int_pr_lifecycle",
    "fact_issue_aging",
    "mart_repo_health_daily",
    "open_issues_daily",
    "latest_version",
    "scd2_from_history",
    "dq_report",
    "dash_pr_series",
    "mart_from_raw",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_session()
    t0 = time.time()
    for build in (fx.pulls_raw, fx.reviews_raw, fx.issues_raw):
        build(spark, sf_dir).count()
    ingest = time.time() - t0
    per_query: dict[str, float] = {}
    for name in names:
        fn = catalog.REGISTRY[name]
        times = []
        for _ in range(runs):
            t = time.time()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.time() - t)
        warm = times[1:] if len(times) > 1 else times
        per_query[name] = round(statistics.median(warm), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(per_query.values()), 3),
        "unit": "sec",
        "queries": per_query,
        "sf": float(m.group(1)) if m else sf_dir,
        "ingest_raw_sec": round(ingest, 3),
        "cpus": int(os.environ.get("BENCH_CPUS", "8")),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
