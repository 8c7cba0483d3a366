"""Edge literals for the column helpers (survey T1-T11, U2, U3)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from repo_pulse.functions import (discounted_amount, hours_between, json_scalar, label_names_csv,
                                  parse_iso_ts, safe_bigint, safe_bool, safe_timestamp, strict_greatest)
from repo_pulse.operators import staging as stg


def _one(spark, col, rows, schema="s string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_json_scalar_objects_and_arrays_are_null(spark):
    rows = [('{"title": "[WIP] fix"}',), ('{"title": "{t}"}',), ('{"title": {"a": 1}}',),
            ('{"title": [1, 2]}',), ('{"title": 12}',), ('{"title": null}',), ('{bad',), ('{}',)]
    df = spark.createDataFrame(rows, "payload string").select(
        "payload", F.from_json("payload", "title string").alias("j"))
    got = [r[0] for r in df.select(json_scalar(F.col("j.title"), F.col("payload"), "$.title")).collect()]
    assert got == ["[WIP] fix", "{t}", None, None, "12", None, None, None]


def test_pull_request_key_presence(spark):
    rows = [('{"pull_request": {"url": "x"}}',), ('{"pull_request": null}',), ('{"number": 1}',)]
    df = spark.createDataFrame(rows, "payload string").select(
        F.from_json("payload", "pull_request variant").alias("j"))
    assert [r[0] for r in df.select(F.col("j.pull_request").isNull()).collect()] == [False, False, True]


def test_safe_casts(spark):
    assert _one(spark, safe_bigint(F.col("s")), [("12",), ("12.5",), ("x",), (None,)]) == [12, None, None, None]
    assert _one(spark, safe_bool(F.col("s")), [("true",), ("FALSE",), ("yes",), ("1",), (None,)]) == \
        [True, False, None, None, None]
    ts = _one(spark, safe_timestamp(F.col("s")).cast("timestamp_ntz"),
              [("2024-01-02T03:04:05Z",), ("2026",), ("12:00",), ("2024-01-02",), ("nope",)])
    assert ts == [dt.datetime(2024, 1, 2, 3, 4, 5), None, None, dt.datetime(2024, 1, 2), None]


def test_parse_iso_ts_is_strict(spark):
    got = _one(spark, parse_iso_ts(F.col("s")).cast("timestamp_ntz"),
               [("2024-01-02T03:04:05Z",), ("2024-01-02T03:04:05.5Z",), ("2024-01-02T03:04:05.123456Z",),
                ("2024-01-02 03:04:05",), ("2024-01-02",)])
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 500000),
                   dt.datetime(2024, 1, 2, 3, 4, 5, 123456), None, None]


def test_hours_between_truncates_toward_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 59, 59)),
                                (dt.datetime(2024, 1, 1, 2, 0), dt.datetime(2024, 1, 1, 0, 30)),
                                (dt.datetime(2024, 1, 1, 0, 0), None)], "a timestamp, b timestamp")
    assert [r[0] for r in df.select(hours_between(F.col("b"), F.col("a"))).collect()] == [0, -1, None]


def test_strict_greatest_is_null_when_any_null(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (3, None)], "a int, b int")
    assert [r[0] for r in df.select(strict_greatest(F.col("a"), F.col("b"))).collect()] == [2, None, None]


def test_labels_count_and_csv(spark):
    rows = [('{"labels": [{"name": "bug"}, {"x": 1}, {"name": "ui"}]}',), ('{"labels": null}',),
            ('{}',), ('{"labels": []}',), ('{"labels": 5}',), ('{"labels": [{"name": {"o": 1}}, {"name": 7}]}',)]
    df = spark.createDataFrame(rows, "payload string").select(
        F.from_json("payload", "labels array<variant>").alias("j"))
    out = df.select(F.coalesce(F.size("j.labels"), F.lit(0)), label_names_csv(F.col("j.labels"))).collect()
    assert [tuple(r) for r in out] == [(3, "bug,ui"), (0, ""), (0, ""), (0, ""), (0, ""), (2, "7")]


def test_review_pr_number_from_url(spark):
    df = spark.createDataFrame([(None, "https://x/pulls/42"), (7, "https://x/pulls/42"), (None, "https://x/p/1"),
                                (None, None)], "n bigint, u string")
    got = [r[0] for r in df.select(stg.review_pr_number(F.col("n"), F.col("u"))).collect()]
    assert got == [42, 7, None, None]


def test_discounted_amount_is_numeric(spark):
    df = spark.createDataFrame([(100.10, 0.05), (None, 0.1)], "p double, d double")
    got = [r[0] for r in df.select(discounted_amount(F.col("p"), F.col("d"))).collect()]
    assert got == [Decimal("-5.005000000"), None]
