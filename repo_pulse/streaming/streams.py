"""ST1-ST3: the batch operators over a file stream of landed NDJSON.

Each micro-batch writes its own part, computed from the batch alone, and
readers combine the parts (merge on read), so the result never depends on how
files are dealt to micro-batches and no row can come too late:

* ST1 ``stream_latest_version``: the batch's latest version per key; readers
  take the latest per key over all parts.
* ST2 ``stream_daily_counts``: the batch's counts per (day, repo); readers add
  them up.
* ST3 ``stream_dedup``: the batch's distinct rows; readers keep one of each.

A part is a folder named by the batch id and is written over, so a retried
batch counts once. All run with ``trigger(availableNow=True)`` and stop when
every file present at the start is processed; a time limit is the caller's
choice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repo_pulse.operators import staging as stg
from repo_pulse.operators.dedup import latest_version, version_order
from repo_pulse.session import new_work_dir
from repo_pulse.sources.landing import LANDING_SCHEMA, REVIEW_LANDING_SCHEMA

# entity: (payload parser, key columns)
ENTITIES: dict[str, tuple[Callable[[DataFrame], DataFrame], list[str]]] = {
    "issues": (stg.parse_issues, ["repo_full_name", "issue_number"]),
    "pulls": (stg.parse_pulls, ["repo_full_name", "pr_number"]),
    "pr_reviews": (stg.parse_reviews, ["repo_full_name", "review_id"]),
}


def landing_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None,
                   with_pr_number: bool = False) -> DataFrame:
    """Landed envelopes as a stream; ``max_files_per_trigger`` bounds a micro-batch, never the result."""
    schema = REVIEW_LANDING_SCHEMA if with_pr_number else LANDING_SCHEMA
    reader = spark.readStream.schema(schema + ", dt string, repo string, run_id string")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(root).select(*[c.split()[0] for c in schema.split(", ")])


def _parts(feed: DataFrame, name: str, part: Callable[[DataFrame], DataFrame], timeout_s: int | None) -> DataFrame:
    """Run the stream; every micro-batch leaves ``part(batch)`` in a folder of its own."""
    spark = feed.sparkSession
    out = new_work_dir(spark, f"stream-{name}")

    empty = part(spark.createDataFrame([], feed.schema))
    empty.write.parquet(f"{out}/batch_id=-1")  # a stream without files has an empty result

    def write(batch: DataFrame, batch_id: int) -> None:
        part(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    q = (feed.writeStream.foreachBatch(write).option("checkpointLocation", new_work_dir(spark, f"ckpt-{name}"))
         .trigger(availableNow=True).queryName(f"stream_{name}").start())
    done = q.awaitTermination(timeout_s) if timeout_s else (q.awaitTermination(), True)[1]
    if not done:
        q.stop()
        raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
    return spark.read.schema(empty.schema).parquet(out).select(empty.schema.fieldNames())


def stream_latest_version(spark: SparkSession, landing_root: str, entity: str = "issues",
                          max_files_per_trigger: int | None = None, timeout_s: int | None = None) -> DataFrame:
    """ST1: landed feed of an entity -> latest version per key; equals the batch staging table."""
    parse, keys = ENTITIES[entity]

    def part(batch: DataFrame) -> DataFrame:
        return latest_version(parse(batch).filter(F.col(keys[-1]).isNotNull()), keys, version_order())

    feed = landing_stream(spark, landing_root, max_files_per_trigger, entity == "pr_reviews")
    found = latest_version(_parts(feed, f"versions-{entity}", part, timeout_s), keys, version_order())
    return found.drop("_tie")


def stream_daily_counts(spark: SparkSession, landing_root: str, max_files_per_trigger: int | None = None,
                        timeout_s: int | None = None) -> DataFrame:
    """ST2: issue events per (UTC day of updated_at, repo), however late they arrive."""
    def part(batch: DataFrame) -> DataFrame:
        return (stg.parse_issues(batch).filter(F.col("updated_at").isNotNull())
                .groupBy(F.to_date("updated_at").alias("metric_date"), "repo_full_name")
                .agg(F.count(F.lit(1)).alias("issue_events_count")))

    parts = _parts(landing_stream(spark, landing_root, max_files_per_trigger), "daily-counts", part, timeout_s)
    return parts.groupBy("metric_date", "repo_full_name").agg(F.sum("issue_events_count").alias("issue_events_count"))


def stream_dedup(spark: SparkSession, landing_root: str, max_files_per_trigger: int | None = None,
                 timeout_s: int | None = None) -> DataFrame:
    """ST3: re-delivered issue versions (same repo, number, updated_at) once, with their first load date."""
    keys = ["repo_full_name", "issue_number", "updated_at"]

    def part(batch: DataFrame) -> DataFrame:
        return (stg.parse_issues(batch).filter(F.col("updated_at").isNotNull())
                .groupBy(*keys).agg(F.min("ingestion_date").alias("ingestion_date")))

    parts = _parts(landing_stream(spark, landing_root, max_files_per_trigger), "dedup", part, timeout_s)
    return parts.groupBy(*keys).agg(F.min("ingestion_date").alias("ingestion_date"))
