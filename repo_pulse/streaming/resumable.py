"""ST1-ST3 as streams that go on where the call before ended.

The caller owns one folder per stream: ``checkpoint`` (which files are done),
``parts`` (what each micro-batch left, one folder per batch id, written over if
the batch is retried) and ``base`` (parts merged by ``compact``). A call reads
the files landed since, whatever became of the call before; readers merge base
and newer parts, so results do not depend on how files fall to batches.

* ST1 ``versions``: latest version per key.
* ST2 ``daily_counts``: counts of tumbling event-time days under a watermark.
  Only days that are still open are carried from batch to batch; a day that the
  watermark passes is final and leaves. Rows of final days are late: they go to
  a side table, are counted, and ``totals`` adds them on read.
* ST3 ``deduplicated``: Spark keeps the keys that arrived within the watermark
  (keyed state, dropped afterwards) and leaves out what is delivered again in
  that time, without a look at any part; later repeats are settled on read.

Scale: a micro-batch costs its own rows; state is one row per open day and repo
(ST2) or per key of the last days (ST3), never the history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repo_pulse.operators import staging as stg
from repo_pulse.operators.dedup import latest_version, version_order
from repo_pulse.operators.part_table import delete
from repo_pulse.streaming.streams import ENTITIES, landing_stream

BASES = "seq long, path string, through long"
DEDUP_KEY = ["repo_full_name", "issue_number", "updated_at"]


@dataclass(frozen=True)
class Parts:
    """The folder of one stream."""

    spark: SparkSession
    root: str
    schema: str

    def read(self) -> DataFrame:
        """Base and newer parts; rows as the batches left them."""
        base, through = self.base()
        try:
            parts = self.spark.read.schema(self.schema + ", batch_id long").parquet(f"{self.root}/parts").filter(F.col("batch_id") > through).drop("batch_id")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            parts = self.spark.createDataFrame([], self.schema)
        return parts if base is None else parts.unionByName(self.spark.read.schema(self.schema).parquet(base))

    def base(self) -> tuple[str | None, int]:
        """(path of the newest base, last batch in it)."""
        try:
            rows = self.spark.read.schema(BASES).parquet(f"{self.root}/bases").collect()  # one row a compaction
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        newest = max(rows, key=lambda r: r["seq"], default=None)
        return (newest["path"], newest["through"]) if newest else (None, -1)

    def write(self, rows: DataFrame, batch_id: int, table: str = "parts") -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{table}/batch_id={batch_id}")

    def compact(self, merge: Callable[[DataFrame], DataFrame], through: int) -> None:
        """Merge base and parts up to the batch ``through`` into a new base, then delete what it holds.

        The new base is current with the one-row write to the list of bases; a
        compaction that dies before leaves all as it was.
        """
        old, since = self.base()
        path = f"{self.root}/base-{through:012d}"
        merge(self.read()).write.mode("overwrite").parquet(path)
        self.spark.createDataFrame([(through, path, through)], BASES).coalesce(1).write.mode("append").parquet(f"{self.root}/bases")
        for k in range(since + 1, through + 1):
            delete(self.spark, f"{self.root}/parts/batch_id={k}")
        if old and old != path:
            delete(self.spark, old)


@dataclass(frozen=True)
class Run:
    """One call: what it read, and the folder it left."""

    parts: Parts
    input_rows: int
    last_batch: int


def _run(feed: DataFrame, root: str, name: str, schema: str, write: Callable[[Parts, DataFrame, int], None], timeout_s: int | None) -> Run:
    """Process all files that the stream's checkpoint does not hold."""
    spark = feed.sparkSession
    parts = Parts(spark, root, schema)
    q = (feed.writeStream.foreachBatch(lambda batch, k: write(parts, batch, k)).option("checkpointLocation", f"{root}/checkpoint")
         .trigger(availableNow=True).queryName(f"resumable_{name}").start())
    done = q.awaitTermination(timeout_s) if timeout_s else (q.awaitTermination(), True)[1]
    if not done:
        q.stop()
        raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
    progress = q.recentProgress
    return Run(parts, sum(p["numInputRows"] for p in progress), max((p["batchId"] for p in progress), default=-1))


def _schema(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


# ---------------------------------------------------------------- ST1


def versions(spark: SparkSession, landing_root: str, root: str, entity: str = "issues", max_files: int | None = None,
             compact_every: int | None = None, timeout_s: int | None = None) -> tuple[DataFrame, Run]:
    """ST1: (latest version per key, the run). ``compact_every``: merge the parts when so many batches have come since the last base."""
    parse, keys = ENTITIES[entity]

    def newest(rows: DataFrame) -> DataFrame:
        return latest_version(rows, keys, version_order())

    def part(batch: DataFrame) -> DataFrame:
        return newest(parse(batch).filter(F.col(keys[-1]).isNotNull()))

    feed = landing_stream(spark, landing_root, max_files, entity == "pr_reviews")
    schema = _schema(part(spark.createDataFrame([], feed.schema)))
    run = _run(feed, root, f"versions_{entity}", schema, lambda p, batch, k: p.write(part(batch), k), timeout_s)
    if compact_every and run.last_batch - run.parts.base()[1] >= compact_every:
        run.parts.compact(newest, run.last_batch)
    return newest(run.parts.read()).drop("_tie"), run


# ---------------------------------------------------------------- ST2

COUNTS = "metric_date date, repo_full_name string, issue_events_count long"
MARKS = "watermark timestamp, open_rows long, late_rows long"


def _table(spark: SparkSession, root: str, table: str, schema: str, batch_id: int | None = None) -> DataFrame:
    """A stream's side table: of one batch, or of all."""
    path = f"{root}/{table}" + ("" if batch_id is None else f"/batch_id={batch_id}")
    try:
        return spark.read.schema(schema).parquet(path).select(*[c.split()[0] for c in schema.split(", ")])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def daily_counts(spark: SparkSession, landing_root: str, root: str, delay: dt.timedelta = dt.timedelta(days=1), max_files: int | None = None,
                 timeout_s: int | None = None) -> Run:
    """ST2: issue events per UTC day and repo; final days in ``closed``, the others in ``open``, rows of final days in ``late``.

    A batch reads the open days and the watermark that the batch before left
    and writes its own, so a retried batch gives the same.
    """
    feed = landing_stream(spark, landing_root, max_files)

    def write(parts: Parts, batch: DataFrame, k: int) -> None:
        mark = _table(spark, root, "marks", MARKS, k - 1).first()
        passed = F.lit(mark["watermark"] if mark else None).cast("timestamp")
        day = F.window("updated_at", "1 day")
        rows = stg.parse_issues(batch).filter(F.col("updated_at").isNotNull()).withColumn("day", day)
        late = F.coalesce(F.col("day.end") <= passed, F.lit(False))
        daily = rows.groupBy(F.to_date("day.start").alias("metric_date"), "repo_full_name", late.alias("late")).agg(
            F.count(F.lit(1)).alias("issue_events_count"), F.max("updated_at").alias("newest"))
        parts.write(daily, k, "batch")
        daily = spark.read.parquet(f"{root}/batch/batch_id={k}")
        seen = daily.agg(F.max("newest").alias("t"), F.coalesce(F.sum(F.when(F.col("late"), F.col("issue_events_count"))), F.lit(0)).alias("late")).first()
        marks = [t for t in (mark and mark["watermark"], seen["t"] and seen["t"] - delay) if t]
        now = max(marks, default=None)
        counts = ["metric_date", "repo_full_name", "issue_events_count"]
        open_ = (_table(spark, root, "open", COUNTS, k - 1).unionByName(daily.filter(~F.col("late")).select(*counts))
                 .groupBy("metric_date", "repo_full_name").agg(F.sum("issue_events_count").alias("issue_events_count")))
        final = F.coalesce(F.date_add("metric_date", 1).cast("timestamp") <= F.lit(now).cast("timestamp"), F.lit(False))
        parts.write(daily.filter("late").select(*counts), k, "late")
        parts.write(open_.filter(final), k, "closed")
        parts.write(open_.filter(~final), k, "open")
        left = _table(spark, root, "open", COUNTS, k).count()
        parts.write(spark.createDataFrame([(now, left, seen["late"])], MARKS), k, "marks")
        for table in ("open", "batch"):
            delete(spark, f"{root}/{table}/batch_id={k - 2}")  # the batch before stays: this one may be retried

    return _run(feed, root, "daily_counts", COUNTS, write, timeout_s)


def _newest_open(spark: SparkSession, root: str) -> DataFrame:
    rows = _table(spark, root, "open", COUNTS + ", batch_id long")
    last = progress(spark, root).agg(F.max("batch_id")).scalar()
    return rows.filter(F.col("batch_id") == last).drop("batch_id")


def final_days(spark: SparkSession, root: str) -> DataFrame:
    """Counts of the days that no later row changes."""
    return _table(spark, root, "closed", COUNTS)


def totals(spark: SparkSession, root: str) -> DataFrame:
    """Counts of all rows so far: final and open days, and late rows on top."""
    if _table(spark, root, "marks", MARKS).isEmpty():
        return spark.createDataFrame([], COUNTS)
    rows = final_days(spark, root).unionByName(_newest_open(spark, root)).unionByName(_table(spark, root, "late", COUNTS))
    return rows.groupBy("metric_date", "repo_full_name").agg(F.sum("issue_events_count").alias("issue_events_count"))


def progress(spark: SparkSession, root: str) -> DataFrame:
    """Per batch: the watermark after it, the rows of open days it carries, the late rows it found."""
    return _table(spark, root, "marks", MARKS + ", batch_id long")


# ---------------------------------------------------------------- ST3


def deduplicated(spark: SparkSession, landing_root: str, root: str, within: str = "2 days", max_files: int | None = None,
                 timeout_s: int | None = None) -> tuple[DataFrame, Run]:
    """ST3: (issue versions once, the run). ``within``: how long after its arrival a version's repeats are dropped by state.

    The clock is the arrival of a batch, so no row is ever too late for it; of
    repeats within that time the first to arrive stays.
    """
    feed = landing_stream(spark, landing_root, max_files)
    rows = stg.parse_issues(feed).filter(F.col("updated_at").isNotNull()).select(*DEDUP_KEY, "ingestion_date")
    rows = rows.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", within).dropDuplicatesWithinWatermark(DEDUP_KEY).drop("arrived")

    def write(parts: Parts, batch: DataFrame, k: int) -> None:
        parts.write(batch, k)

    run = _run(rows, root, "dedup", _schema(rows), write, timeout_s)
    found = run.parts.read().groupBy(*DEDUP_KEY).agg(F.min("ingestion_date").alias("ingestion_date"))
    return found, run
