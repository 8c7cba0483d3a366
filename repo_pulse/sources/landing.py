"""Landing envelopes, partitioned NDJSON landing zone, raw append.

A landing line is one JSON object: ``ingestion_date``, ``repo_full_name``,
(reviews: ``pr_number``), ``event_type`` and the API record as a nested
``payload`` object. Reading it back with a declared schema that types
``payload`` as STRING keeps the object's JSON text, so the raw table holds
the document verbatim and staging parses it once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repo_pulse.session import PARQUET_OPTIONS

# Envelope schema and landing layout.
LANDING_SCHEMA = "ingestion_date date, repo_full_name string, event_type string, payload string"
REVIEW_LANDING_SCHEMA = ("ingestion_date date, repo_full_name string, pr_number bigint, "
                         "event_type string, payload string")
EVENT_TYPES = {"pulls": "pull", "issues": "issue", "pr_reviews": "pr_review"}
CHUNK_RECORDS = 2000
PARTITION_COLS = ["dt", "repo", "run_id"]
RUN_LIST = "_runs"  # beside the day folders; Spark's readers pass over names with an underscore


def envelope(records: DataFrame, event_type: str, as_of: dt.date,
             payload_cols: Sequence[str | Column], repo_col: str = "repo_full_name",
             pr_number_col: str | None = None) -> DataFrame:
    """Wrap API records as raw rows stamped with the load date.

    NULL fields are written as JSON null (``ignoreNullFields=false``), as a
    JSON dump of the record would.
    """
    payload = F.to_json(F.struct(*payload_cols), {"ignoreNullFields": "false"})
    cols = [F.lit(as_of).alias("ingestion_date"), F.col(repo_col).alias("repo_full_name")]
    if pr_number_col:
        cols.append(F.col(pr_number_col).cast("bigint").alias("pr_number"))
    cols += [F.lit(event_type).alias("event_type"), payload.alias("payload")]
    return records.select(*cols)


def landing_lines(raw: DataFrame, load_date: dt.date | Column | None = None, run_id: Column | None = None) -> DataFrame:
    """One NDJSON line per raw row, the payload nested as an object.

    ``dt`` is the run's load date when given, else the row's ingestion date.
    """
    fields = [F.col("ingestion_date").cast("string").alias("ingestion_date"), "repo_full_name"]
    if "pr_number" in raw.columns:
        fields.append("pr_number")
    fields += ["event_type", F.parse_json("payload").alias("payload")]
    day = F.col("ingestion_date") if load_date is None else load_date if isinstance(load_date, Column) else F.lit(load_date)
    return raw.select(
        day.cast("string").alias("dt"),
        F.replace(F.col("repo_full_name"), F.lit("/"), F.lit("__")).alias("repo"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
        *([run_id.alias("run_id")] if run_id is not None else []))


def write_landing(raw: DataFrame, root: str, run_id: str | Column, max_records: int = CHUNK_RECORDS,
                  load_date: dt.date | Column | None = None) -> None:
    """Append to ``root/dt=../repo=../run_id=..`` in files of <= max_records lines.

    ``run_id`` and ``load_date`` may be columns of ``raw``: many runs then land in one pass.

    A plain repartition by (dt, repo) would put a repo holding a third of
    the rows into one task; the REBALANCE hint lets AQE split such a
    partition over several tasks and merge small ones. A new run id never
    touches files of an earlier run.
    """
    run = run_id if isinstance(run_id, Column) else F.lit(run_id)
    lines = landing_lines(raw, load_date, run)
    # one row a run: which folders it wrote, so that a reader of the run lists no others
    landed = lines.groupBy("run_id").agg(F.collect_set(F.struct("dt", "repo")).alias("folders"))
    (lines.hint("rebalance", "dt", "repo").write.mode("append")
          .option("maxRecordsPerFile", max_records)
          .partitionBy(*PARTITION_COLS)
          .text(root))
    landed.write.mode("append").parquet(f"{root}/{RUN_LIST}")


def run_folders(spark: SparkSession, root: str, runs: Sequence[str], since: str | None = None) -> list[str]:
    """Folders of the runs named, from the list of landed runs; ``since``: the first load day of interest.

    The list has one row a run and the driver gets the folders of these runs
    alone. A run that another writer landed is not in it; its folders are found
    by name.
    """
    names = [f"{root}/dt=*/repo=*/run_id={escaped(spark, r)}" for r in runs]

    def there(name: str) -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path))

    try:
        listed = spark.read.schema("run_id string, folders array<struct<dt:string,repo:string>>").parquet(f"{root}/{RUN_LIST}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return [n for n in names if there(n)]
    listed = listed.filter(F.col("run_id").isin(list(runs)))
    found = {r["run_id"] for r in listed.select("run_id").distinct().collect()}
    rows = listed.select("run_id", F.inline("folders")).distinct()
    if since:
        rows = rows.filter(F.col("dt") >= since)
    out = [f"{root}/dt={escaped(spark, r['dt'])}/repo={escaped(spark, r['repo'])}/run_id={escaped(spark, r['run_id'])}" for r in rows.collect()]
    return sorted(out) + [n for n, r in zip(names, runs) if r not in found and there(n)]


def escaped(spark: SparkSession, value: str | None) -> str:
    """A partition value as Spark names its folder."""
    if value is None or value == "":
        return "__HIVE_DEFAULT_PARTITION__"
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def read_landing(spark: SparkSession, path: str, with_pr_number: bool = False, runs: Sequence[str] | None = None,
                 since: str | None = None) -> DataFrame:
    """Scan landed NDJSON with the declared envelope schema.

    Partition columns (dt, repo, run_id) are available for pruning, e.g.
    ``.filter(F.col('dt') >= '2024-03-01')`` reads only those folders. With
    ``runs`` only the folders of these runs are listed at all, and with
    ``since`` only those of load days from it on.
    """
    schema = REVIEW_LANDING_SCHEMA if with_pr_number else LANDING_SCHEMA
    if runs:
        folders = run_folders(spark, path, runs, since)
        whole = schema + ", dt date, repo string, run_id string"
        df = spark.read.schema(whole).option("basePath", path).json(folders) if folders else spark.createDataFrame([], whole)
    else:
        df = spark.read.schema(schema).json(path)
    base = [c.split()[0] for c in schema.split(", ")]
    return df.select(*base, *[c for c in PARTITION_COLS if c in df.columns])


def append_raw(raw: DataFrame, table_path: str) -> None:
    """Append rows to the raw table (parquet, append-only)."""
    raw.write.mode("append").options(**PARQUET_OPTIONS).parquet(table_path)
