"""Dates, daily series and typed parsing."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from layerwright.functions import dates as D
from layerwright.functions import pgtypes as P
from layerwright.operators.series import daily_fill, expand_days


def day(text):
    return dt.date.fromisoformat(text)


def test_expand_days(spark, collected):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 29, 23)), (2, dt.datetime(2024, 1, 31)), (3, dt.datetime(2024, 2, 1)), (4, None)],
        "id int, created timestamp_ntz",
    )
    got = collected(expand_days(df, "created", "2024-01-31").select("id", "day"), "id", "day")
    assert [(r["id"], r["day"].day) for r in got] == [(1, 29), (1, 30), (1, 31), (2, 31)]


def brute_series(entities, activity, variants, as_of):
    out = []
    for key, name, start in entities:
        if start is None:
            continue
        current = start
        while current <= as_of:
            n = sum(a for k, d, a in activity if (k, d) == (key, current))
            found = [v for k, d, v in variants if (k, d) == (key, current)] or [0]
            out.extend((key, name, current, n, v) for v in found)
            current += dt.timedelta(days=1)
    return sorted(out)


def test_daily_fill_against_brute_force(spark):
    as_of = day("2024-01-10")
    entities = [
        (1, "a", day("2024-01-03")), (1, "b", day("2024-01-05")), (2, "c", day("2024-01-10")),
        (3, "d", day("2024-01-11")), (4, "e", None), (5, "f", day("2024-01-08")),
    ]
    activity = [
        (1, day("2024-01-01"), 9), (1, day("2024-01-04"), 2), (1, day("2024-01-04"), 3), (1, day("2024-01-10"), 1),
        (2, day("2024-01-12"), 5), (7, day("2024-01-05"), 5), (None, day("2024-01-05"), 5), (1, None, 4),
    ]
    variants = [(1, day("2024-01-06"), 4), (1, day("2024-01-06"), 5), (5, day("2024-01-08"), 6), (1, day("2024-01-02"), 8)]
    got = daily_fill(
        spark.createDataFrame(entities, "id int, name string, created date"),
        spark.createDataFrame(activity, "id int, day date, n long"), "id", "created", "day", ["n"], as_of,
        variants=spark.createDataFrame(variants, "id int, day date, v long"),
    ).select("id", "name", "day", "n", "v")
    assert sorted(tuple(r) for r in got.collect()) == brute_series(entities, activity, variants, as_of)


def test_run_window_is_half_open(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in (8, 9, 10, 11, 12)], "t timestamp_ntz")
    assert [r.t.day for r in df.where(D.run_window(F.col("t"), "2024-01-10", 1, 2)).orderBy("t").collect()] == [9, 10, 11]


def test_open_interval_and_latest(spark):
    df = spark.createDataFrame([(1, None), (1, 3), (3, 1)], "a int, b int").withColumn("m", D.latest(F.col("a"), F.col("b")))
    assert [r.m for r in df.collect()] == [1, 3, 3]
    assert df.where(D.inside_open_interval(F.col("m"), F.lit(1), F.lit(3))).count() == 0
    assert df.where(D.inside_open_interval(F.col("m"), F.lit(1))).count() == 2
    assert df.where(D.inside_open_interval(F.col("m"))).count() == 3


def test_pg_timestamp_and_defaults(spark):
    row = spark.range(1).select(
        D.pg_timestamp(F.lit(-1).cast("long")).cast("string").alias("before"),
        D.day_or_default(F.lit(""), "2024-01-31").alias("blank"),
        D.day_or_default(F.lit("2024-02-03"), "2024-01-31").alias("given"),
        D.message_time(F.lit("2024-02-03 04:05:06").cast("timestamp")).alias("shown"),
    ).first()
    assert row.before == "1999-12-31 23:59:59.999999"
    assert (row.blank, row.given, row.shown) == (day("2024-01-31"), day("2024-02-03"), "03/02/2024 04:05")


@pytest.mark.parametrize(("kind", "text", "expected"), [
    (16, "f", False), (16, "t", True), (17, "\\x01ff", bytearray(b"\x01\xff")), (20, "9000000000", 9000000000),
    (23, "x", None), (701, "1.5", 1.5), (790, "$1,234.50", "1234.50"), (1082, "2024-01-02", day("2024-01-02")),
    (1114, "2024-01-02 03:04:05.5", dt.datetime(2024, 1, 2, 3, 4, 5, 500000)), (25, "x", "x"), (3802, "{}", "{}"),
])
def test_parse_value(spark, kind, text, expected):
    value = spark.createDataFrame([(text,)], "v string").select(P.parse_value(F.col("v"), kind)).first()[0]
    assert (str(value) if kind == 790 else value) == expected


def test_numeric_types():
    assert P.spark_type(1700, ((10 << 16) | 2) + 4) == "decimal(10,2)"
    assert P.spark_type(1700, ((10 << 16) | 2) + 4, parity=True) == "double"
    assert P.spark_type(1700) == "double"
    with pytest.raises(ValueError):
        P.spark_type(1)
