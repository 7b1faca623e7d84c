"""De-duplication, joins, table changes and data tests on small fixtures."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from layerwright.operators import joins as J
from layerwright.operators import quality as dq
from layerwright.operators import tables as T
from layerwright.operators.dedup import any_per_key, latest_per_key


def test_latest_per_key(spark):
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame(
        [(1, old, "a"), (1, new, "b"), (1, new, "c"), (2, None, "d"), (2, new, "e"), (None, old, "f"), (None, new, "g")],
        "id int, updated_at timestamp_ntz, v string",
    )
    assert sorted((r.id or 0, r.v) for r in latest_per_key(df, ["id"]).collect()) == [(0, "g"), (1, "c"), (2, "d")]
    last = latest_per_key(df, ["id"], nulls_win=False)
    assert sorted((r.id or 0, r.v) for r in last.collect()) == [(0, "g"), (1, "c"), (2, "e")]
    assert any_per_key(df, ["id"]).count() == 3


def skewed(rows=3000, seed=7):
    """A third of the rows on one key, a third without a key, copies of whole rows."""
    rnd = random.Random(seed)
    out = []
    for i in range(rows):
        key = 1 if i % 3 == 0 else None if i % 3 == 1 else rnd.randint(2, 60)
        out.append((key, i if i % 5 else 0))
    return out


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("salt", [1, 7])
def test_spread_join_equals_plain_join(spark, how, salt):
    left = spark.createDataFrame(skewed(), "k int, v int").repartition(6)
    right = spark.createDataFrame([(k, k * 10) for k in range(0, 40)] + [(1, 11), (None, 5)], "k int, w int")
    expected = left.join(right, ["k"], how)
    got = J.spread_join(left, right, ["k"], how, salt)
    assert got.columns == expected.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_copies_of_one_row_spread_too(spark):
    copies = spark.range(0, 4000, 1, 40).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    pieces = copies.withColumn("p", J.row_piece(copies, F.lit(8))).groupBy("p").count()
    assert pieces.count() >= 6


def test_lookup_many_equals_left_join(spark):
    left = spark.createDataFrame([(k, f"n{k}") for k in range(100)] + [(None, "none")], "k int, n string")
    right = spark.createDataFrame(skewed(), "k int, v int")
    expected = left.join(right, ["k"], "left")
    got = J.lookup_many(left, right, ["k"])
    assert got.columns == expected.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_split_known(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    update, configure = J.split_known(rows, spark.createDataFrame([(2,), (2,)], "id int"), "id")
    assert [r.id for r in update.collect()] == [2]
    assert sorted(r.id for r in configure.collect()) == [1, 3]


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    batch = spark.createDataFrame([(2, "B", True), (4, "D", None)], "id int, v string, extra boolean")
    got = sorted(tuple(r) for r in T.upsert(target, batch, "id").collect())
    assert got == [(1, "a", None), (2, "B", True), (3, "c", None), (4, "D", None)]
    assert T.change_counts(target, batch, "id").first().asDict() == {"rows_deleted": 1, "rows_written": 2}
    assert T.upsert(target, batch.limit(0), "id").count() == 3


def test_high_water_mark(spark):
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3)
    df = spark.createDataFrame([(1, old, None), (2, old, new), (3, new, None)], "id int, a timestamp_ntz, b timestamp_ntz")
    mark = F.lit(dt.datetime(2024, 1, 2)).cast("timestamp_ntz")
    fresh = T.newer_than(df, ["a", "b"], mark)
    assert sorted(r.id for r in fresh.collect()) == [2, 3]
    assert T.high_water_mark(fresh.where("false"), "a").first()[0] is None


def test_page_limits(spark):
    df = spark.range(10)
    assert [r.id for r in T.page(df, ["id"], 3, 2).collect()] == [3, 4]
    assert [r.id for r in T.page_after(df, "id", 7, 5).collect()] == [8, 9]
    assert T.page_after(df, "id", None, 3).count() == 3
    assert T.page(df, ["id"], 10**8, 1).count() == 0


def test_data_tests(spark):
    origin = spark.createDataFrame([(1,), (2,), (2,), (None,), (3,)], "id int")
    model = spark.createDataFrame([(1, "proposal"), (2, "comment"), (None, "comment")], "ref int, kind string")
    keep = F.col("kind") == "proposal"
    complete = dq.completeness(model, "ref", origin, "id")
    assert sorted(r.id for r in complete.collect()) == [3]
    assert sorted(r.id for r in dq.completeness(model, "ref", origin, "id", keep).collect()) == [2, 2, 3]
    assert dq.completeness(model, "ref", origin, "id", keep, parity=True).count() == 0
    assert dq.completeness(model, "ref", origin, "id", origin_filter=F.col("id") < 3).count() == 0
    lost = dq.referential(model, "ref", origin, "id")
    assert [tuple(r) for r in lost.collect()] == [(None, "comment")]
    assert dq.unique(origin, "id").collect()[0].asDict() == {"id": 2, "n_records": 2}
    assert dq.not_null(origin, "id").count() == 1


def test_report_gates_publication(spark):
    df = spark.createDataFrame([(1,), (None,)], "id int")
    results = dq.report({"m.not_null": lambda: dq.not_null(df, "id"), "m.unique": lambda: dq.unique(df, "id")})
    assert {r.test: r.failures for r in results.collect()} == {"m.not_null": 1, "m.unique": 0}
    with pytest.raises(dq.TestsFailed, match="m.not_null: 1"):
        dq.require_passed(results)
    dq.require_passed(results, allow=["m.not_null"])
