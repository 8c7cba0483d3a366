"""Incremental = full refresh; upsert properties; SCD2 range properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from repo_pulse.operators import history as hist
from repo_pulse.operators import lifecycle as lc
from repo_pulse.operators import staging as stg
from repo_pulse.operators import upsert as up
from repo_pulse.operators.dedup import latest_version, version_order
from repo_pulse.sources import fixtures as fx

from inputs import SF_SMALL


def _same(a, b):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0
    assert b.select(*cols).exceptAll(a.select(*cols)).count() == 0


@pytest.mark.parametrize("split", [dt.date(1997, 6, 1), dt.date(2001, 1, 1)])
def test_incremental_equals_full_refresh(spark, split):
    praw, rraw = fx.pulls_raw(spark, SF_SMALL), fx.reviews_raw(spark, SF_SMALL)
    first = lambda df: df.filter(F.col("ingestion_date") < F.lit(split))
    rest = lambda df: df.filter(F.col("ingestion_date") >= F.lit(split))
    sp1 = up.commit_version(latest_version(stg.parse_pulls(first(praw)).filter(F.col("pr_number").isNotNull()),
                                           up.PULL_KEY, version_order()), "t_stg_pulls")
    sr1 = up.commit_version(latest_version(stg.parse_reviews(first(rraw)).filter(F.col("review_id").isNotNull()),
                                           up.REVIEW_KEY, version_order()), "t_stg_reviews")
    agg1 = up.commit_version(lc.reviews_agg(sr1.filter(F.col("pr_number").isNotNull())), "t_agg")
    life1 = up.commit_version(lc.pr_lifecycle(sp1, agg1), "t_life")
    sr2, changed_r = up.review_versions_update(sr1, rest(rraw))
    sr2, changed_r = up.commit_version(sr2, "t_stg_reviews"), up.commit_version(changed_r, "t_changed")
    sp2, changed_p = up.pull_versions_update(sp1, rest(praw))
    sp2, changed_p = up.commit_version(sp2, "t_stg_pulls"), up.commit_version(changed_p, "t_changed_p")
    agg2 = up.commit_version(up.reviews_agg_incremental(agg1, sr2, changed_r), "t_agg")
    life2 = up.pr_lifecycle_incremental(life1, sp2, agg2, changed_p, changed_r)
    full_agg = lc.reviews_agg(stg.stg_reviews(rraw))
    _same(agg2, full_agg)
    _same(life2, lc.pr_lifecycle(stg.stg_pulls(praw), full_agg))


def test_upsert_twice_equals_once_and_duplicates_refused(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    s = spark.createDataFrame([(2, "B"), (3, "c")], "k bigint, v string")
    once = up.upsert_by_key(t, s, ["k"])
    _same(once, up.upsert_by_key(once, s, ["k"]))
    assert sorted(tuple(r) for r in once.collect()) == [(1, "a"), (2, "B"), (3, "c")]
    with pytest.raises(up.DuplicateKeyError):
        up.assert_unique_keys(s.unionByName(s), ["k"])
    with pytest.raises(up.DuplicateKeyError):
        up.upsert_by_key(t, s.unionByName(s), ["k"])


def test_schema_sync_adds_and_drops_columns(spark):
    t = spark.createDataFrame([(1, "a", True)], "k bigint, v string, legacy boolean")
    s = spark.createDataFrame([(2, "b", 5)], "k bigint, v string, extra int")
    out = up.upsert_by_key(t, s, ["k"])
    assert out.columns == ["k", "v", "extra"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", None), (2, "b", 5)]


def test_lookback_cutoff_commutes_with_dedup(spark):
    parsed = stg.parse_pulls(fx.pulls_raw(spark, SF_SMALL)).filter(F.col("pr_number").isNotNull())
    target = stg.stg_pulls(fx.pulls_raw(spark, SF_SMALL, versions=(0,)))
    before = latest_version(up.lookback_filter(parsed, target), up.PULL_KEY, version_order())
    after = up.lookback_filter(latest_version(parsed, up.PULL_KEY, version_order()), target)
    _same(before, after)


def _ranges_ok(h):
    rows = h.select("snapshot_key", "valid_from", "valid_to", "version_id").collect()
    assert all(r.valid_to is None or r.valid_from < r.valid_to for r in rows)
    assert len({r.version_id for r in rows}) == len(rows)
    by = {}
    for r in rows:
        by.setdefault(r.snapshot_key, []).append((r.valid_from, r.valid_to))
    for spans in by.values():
        spans.sort(key=lambda x: (x[0], x[1] is None, x[1] or x[0]))
        assert sum(1 for _, e in spans if e is None) <= 1
        for (s1, e1), (s2, _) in zip(spans, spans[1:]):
            assert e1 is not None and e1 <= s2


def test_scd2_properties_and_reappearance(spark):
    now = dt.datetime(2024, 3, 1)
    v0 = stg.stg_pulls(fx.pulls_raw(spark, SF_SMALL, versions=(0,)))
    full = stg.stg_pulls(fx.pulls_raw(spark, SF_SMALL))
    gone = stg.stg_pulls(fx.pulls_raw(spark, SF_SMALL, drop_mod10=True))
    h = up.commit_version(hist.scd2_merge(None, v0, now), "t_hist")
    h = up.commit_version(hist.scd2_merge(h, full, now), "t_hist")
    h_same = hist.scd2_merge(h, full, now)  # no change -> identical history
    _same(h, h_same)
    h = up.commit_version(hist.scd2_merge(h, gone, now), "t_hist")
    later = dt.datetime(2024, 3, 2)
    h = up.commit_version(hist.scd2_merge(h, full, later), "t_hist")  # deleted keys come back
    _ranges_ok(h)
    back = h.filter((F.col("pr_number") % 10 == 0) & F.col("valid_to").isNull())
    assert back.count() == full.filter(F.col("pr_number") % 10 == 0).count()
    _ranges_ok(hist.scd2_from_history(stg.parse_pulls(fx.pulls_raw(spark, SF_SMALL))))


@pytest.mark.parametrize("seed", range(6))
def test_scd2_delete_return_update_cycles(spark, seed):
    """Random presence and update times per run: ranges stay ordered, disjoint and uniquely named."""
    import random

    r = random.Random(seed)
    template = stg.stg_pulls(fx.pulls_raw(spark, SF_SMALL, versions=(0,))).limit(3).collect()
    schema = stg.stg_pulls(fx.pulls_raw(spark, SF_SMALL, versions=(0,))).schema
    h = None
    for run in range(5):
        now = dt.datetime(2024, 1, 10 + 3 * run)
        rows = [{**t.asDict(), "updated_at": dt.datetime(2024, 1, r.randint(1, 25))} for t in template if r.random() < 0.6]
        h = up.commit_version(hist.scd2_merge(h, spark.createDataFrame([tuple(x[f] for f in schema.fieldNames()) for x in rows], schema), now), "t_cycles")
        _ranges_ok(h)


def test_scd2_reappearance_of_the_review(spark):
    """Updated day 10, deleted day 20, back on day 22 unchanged, then updated as of day 15."""
    base = stg.stg_pulls(fx.pulls_raw(spark, SF_SMALL, versions=(0,))).limit(1)
    on = lambda d: base.withColumn("updated_at", F.lit(dt.datetime(2024, 1, d)))
    h = hist.scd2_merge(None, on(10), dt.datetime(2024, 1, 11))
    h = up.commit_version(hist.scd2_merge(h, base.limit(0), dt.datetime(2024, 1, 20)), "t_back")
    h = up.commit_version(hist.scd2_merge(h, on(10), dt.datetime(2024, 1, 22)), "t_back")
    h = up.commit_version(hist.scd2_merge(h, on(15), dt.datetime(2024, 1, 23)), "t_back")
    _ranges_ok(h)
    spans = sorted((x.valid_from.day, x.valid_to.day if x.valid_to else None) for x in h.collect())
    assert spans == [(10, 20), (20, None)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_labels_count_does_not_depend_on_ansi(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        raw = spark.createDataFrame([("r", '{"number": 1, "labels": [{"name": "a"}]}'), ("r", '{"number": 2}'), ("r", '{"number": 3, "labels": 5}')],
                                    "repo_full_name string, payload string").selectExpr("DATE '2024-01-01' AS ingestion_date", "repo_full_name", "'issue' AS event_type", "payload")
        got = {x.issue_number: x.labels_count for x in stg.parse_issues(raw).collect()}
        assert got == {1: 1, 2: 0, 3: 0}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_first_run_is_full_or_lookback(spark):
    from repo_pulse.sources import cursors as cur

    now = dt.datetime(2024, 1, 20)
    feed = spark.createDataFrame([("a", 1, dt.datetime(2023, 1, 1)), ("a", 2, dt.datetime(2024, 1, 19)), ("a", 3, None),
                                  ("b", 4, dt.datetime(2024, 1, 1)), ("b", 5, dt.datetime(2024, 1, 5))], "repo_full_name string, n int, updated_at timestamp")
    cursors = spark.createDataFrame([("pulls", "b", dt.datetime(2024, 1, 5))], "entity string, repo_full_name string, last_updated_at timestamp")
    ids = lambda first: sorted(x.n for x in cur.changed_feed(feed, cursors, "pulls", now, first).collect())
    assert ids("full") == [1, 2, 3, 5] and ids("lookback") == [2, 5]
