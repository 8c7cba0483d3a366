"""H1-H4: slowly-changing (type 2) history of pull request state.

Each version row carries ``version_id = md5(key || '|' || valid_from)``,
``valid_from`` (= ``updated_at``, or the reappearance time after a hard
delete) and ``valid_to`` (NULL while current). Ranges
of one key never overlap and at most one row per key is open.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repo_pulse.operators.dedup import latest_version, version_order

# Tracked columns of the PR history.
TRACKED = ["repo_full_name", "pr_number", "pull_request_id", "pull_request_state", "pull_request_title",
           "author_login", "is_draft", "created_at", "updated_at", "closed_at", "merged_at"]
HISTORY_COLS = ["snapshot_key", *TRACKED, "version_id", "valid_from", "valid_to"]


def snapshot_key(repo: Column, number: Column) -> Column:
    """H4: ``repo-number``; NULL when either part is NULL."""
    return F.concat(repo, F.lit("-"), number.cast("string"))


def _version_id(key: Column, updated: Column) -> Column:
    return F.md5(F.concat(key, F.lit("|"), updated.cast("string")))


def as_versions(snapshot: DataFrame) -> DataFrame:
    """Snapshot rows as new open versions."""
    key = snapshot_key(F.col("repo_full_name"), F.col("pr_number"))
    return snapshot.select(
        key.alias("snapshot_key"), *TRACKED,
        _version_id(key, F.col("updated_at")).alias("version_id"),
        F.col("updated_at").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"))


def scd2_merge(history: DataFrame | None, snapshot: DataFrame, now: dt.datetime,
               invalidate_hard_deletes: bool = True) -> DataFrame:
    """H1: the whole history after a snapshot, see ``scd2_step``."""
    if history is None:
        return as_versions(snapshot)
    closed = history.filter(F.col("valid_to").isNotNull())
    step = scd2_step(history.filter(F.col("valid_to").isNull()), closed, snapshot, now, invalidate_hard_deletes)
    return closed.select(*HISTORY_COLS).unionByName(step)


def scd2_step(open_: DataFrame, closed: DataFrame, snapshot: DataFrame, now: dt.datetime,
              invalidate_hard_deletes: bool = True) -> DataFrame:
    """H1: the open versions and those newly closed after merging one snapshot of the source into the history (timestamp strategy).

    * key without an open version -> new open version (first sight or reappearance);
    * newer ``updated_at`` -> open version closed at the new ``updated_at``, new one opened;
    * same or older ``updated_at`` -> nothing changes;
    * open key missing from the snapshot -> closed at ``now`` (hard delete).
    A version opens at the latest of its ``updated_at``, the open version's
    start and the key's last close, and the old one closes there, so ranges of
    a key never overlap and ``valid_from < valid_to``. A version that would
    end where it began was never current and leaves the history, so
    ``version_id`` stays unique. The snapshot gets the last close of its keys,
    which counts for keys that have no open version, and one full outer join
    with the open versions follows: every joined row gives its old and its new
    version at once, so the snapshot's plan runs once. Versions closed before
    are not part of the result: they never change again.
    """
    last_close = closed.groupBy("snapshot_key").agg(F.max("valid_to").alias("_last_close"))
    snap = as_versions(snapshot).join(last_close, "snapshot_key", "left")
    o, s = open_.alias("o"), snap.alias("s")
    j = o.join(s, F.col("o.snapshot_key") == F.col("s.snapshot_key"), "full_outer")
    has_o, has_s = F.col("o.version_id").isNotNull(), F.col("s.version_id").isNotNull()
    newer = has_o & has_s & (F.col("s.updated_at") > F.col("o.updated_at"))
    ts_now = F.lit(now).cast("timestamp")
    start = F.greatest(F.col("s.updated_at"), F.col("o.valid_from"))  # NULL open version: the new one's own time
    old_valid_to = (F.when(newer, start)
                     .when(has_o & ~has_s & F.lit(invalidate_hard_deletes), F.greatest(ts_now, F.col("o.valid_from"))))
    last = F.when(~has_o, F.col("s._last_close"))
    new_from = F.greatest(start, last)
    old = F.struct(*[F.col("o." + c).alias(c) for c in HISTORY_COLS[:-1]], old_valid_to.alias("valid_to"))
    new = F.struct(*[F.col("s." + c).alias(c) for c in HISTORY_COLS[:-3]],
                   _version_id(F.col("s.snapshot_key"), new_from).alias("version_id"), new_from.alias("valid_from"),
                   F.lit(None).cast("timestamp").alias("valid_to"))
    versions = F.array(
        F.when(has_o & (old_valid_to.isNull() | (old_valid_to > F.col("o.valid_from"))), old),
        F.when(has_s & (~has_o | newer), new))
    return j.select(F.inline(F.array_compact(versions)))


def scd2_from_history(versions: DataFrame) -> DataFrame:
    """H2: history from every recorded version, not only those seen at snapshot runs.

    Versions with the same (key, updated_at) collapse to one (W1 order);
    versions without ``updated_at`` cannot be placed in time and are left
    out. ``valid_to`` is the next version's ``updated_at``.
    """
    v = versions.filter(F.col("pr_number").isNotNull() & F.col("updated_at").isNotNull())
    one = latest_version(v, ["repo_full_name", "pr_number", "updated_at"], version_order())
    w = Window.partitionBy("repo_full_name", "pr_number").orderBy("updated_at")
    return as_versions(one).withColumn("valid_to", F.lead("updated_at").over(w)).select(*HISTORY_COLS)


def scd2_as_of(history: DataFrame, t: dt.datetime) -> DataFrame:
    """H3: the version of every key that was current at time ``t``."""
    ts = F.lit(t).cast("timestamp")
    return history.filter((F.col("valid_from") <= ts) & (F.col("valid_to").isNull() | (F.col("valid_to") > ts)))
