"""SparkSession settings and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so that date(ts) is the UTC date, AQE for
# runtime coalescing and skew splitting, no UI server.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "repo_pulse") -> SparkSession:
    """The session with the settings above.

    Under spark-submit master, memory and shuffle partitions are the submit's;
    started as plain Python (tests, bench) it is a local session with one
    shuffle partition per core.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app_name)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if master or "PYSPARK_GATEWAY_PORT" not in os.environ:
        builder = builder.master(master or f"local[{cpus}]")
        builder = builder.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        shuffle_partitions = shuffle_partitions or int(cpus)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_settings(spark)
    return spark


#: Stored tables: JSON text takes less space than under the default codec; row groups are small enough that a
#: file of a million rows is read by several tasks.
PARQUET_OPTIONS = {"compression": "zstd", "parquet.block.size": str(16 << 20)}
#: A payload parsed and typed takes many times its stored size; larger splits made the sorts of the dedup spill.
SPLIT_BYTES = 32 << 20


def ensure_session_settings(spark: SparkSession) -> None:
    """Pin the settings results depend on (UTC dates) on any session, and bound the bytes that a scan task reads."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() > SPLIT_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES))


#: Spark's setting by which a query's shuffle files are deleted as it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes made inside are deleted when each write ends.

    Else they stay on the executors' disks until the driver happens to collect
    its garbage, so a chain of stored tables holds the shuffles of all its steps.
    A write is planned anew each time, so nothing reads its shuffles again.
    """
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def work_root(spark: SparkSession) -> str:
    """Shared folder for written tables: the cluster's checkpoint dir.

    Read from the session. A local session without one gets a folder under the
    system temp dir; on a cluster that folder would differ on every machine,
    so a missing setting is an error there.
    """
    d = spark.sparkContext.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if d:
            spark.sparkContext.setCheckpointDir(d)
            d = spark.sparkContext.getCheckpointDir() or d
    if not d and not re.match(r"local($|\[)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="repo_pulse-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused directory under the shared work folder."""
    root = work_root(spark).rstrip("/")
    return f"{root}/repo_pulse/{name}-{uuid.uuid4().hex[:12]}"


def delete(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))
