"""Sinks lose nothing: in both overwrite modes of a session, with parts that grow, after failures, and reading a batch once."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from layerwright.operators import tables as pure
from layerwright.sources import writers as W

MODE = "spark.sql.sources.partitionOverwriteMode"


@pytest.fixture(params=["static", "dynamic"])
def mode(spark, request):
    spark.conf.set(MODE, request.param)
    yield request.param
    spark.conf.unset(MODE)


def held(spark, name, *columns):
    return sorted((tuple(r) for r in spark.table(name).select(*columns).collect()), key=str)


def leftovers(spark, database):
    return [r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect() if "__staged_" in r.tableName]


def test_an_upsert_of_one_part_leaves_the_others(spark, mode):
    name = f"sk1_{mode}.u"
    assert W.upsert(spark.range(5000).select("id", F.lit("a").alias("v")), name, "id", range_size=500) == W.Changed(0, 5000)
    assert W.upsert(spark.range(1200, 1210).select("id", F.lit("b").alias("v")), name, "id") == W.Changed(10, 10)
    assert held(spark, name, "id", "v") == sorted(((i, "b" if 1200 <= i < 1210 else "a") for i in range(5000)), key=str)
    assert W._properties(spark, name)[W.ROWS] == "5000" and not leftovers(spark, f"sk1_{mode}")


def test_days_that_are_not_replaced_stay(spark, mode):
    name = f"sk2_{mode}.d"
    rows = spark.range(400).select("id", F.expr("date_add(DATE'2024-01-01', cast(id % 40 as int))").alias("day"))
    assert W.replace_days(rows, name, "day") == W.Changed(0, 400)
    late = spark.range(3).select((F.col("id") + 1000).alias("id"), F.lit("2024-01-05").cast("date").alias("day"))
    assert W.replace_days(late, name, "day") == W.Changed(10, 3)
    got = [r.id for r in spark.table(name).collect()]
    assert sorted(got) == sorted([i for i in range(400) if i % 40 != 4] + [1000, 1001, 1002])
    assert spark.table(name).where("day = DATE'2024-01-05'").count() == 3


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_many_batches_equal_the_pure_form(spark, mode, kind):
    """Text keys are in hash parts that split as the table grows; no batch touches all of them."""
    name, draw = f"sk3_{mode}_{kind}.u", random.Random(kind)
    want: dict = {}
    no_key = 0
    for step in range(8):
        keys = draw.sample(range(60), 5)
        rows = [(str(k) if kind == "string" else k, step) for k in keys] + ([(None, step)] if step % 3 == 0 else [])
        changed = W.upsert(spark.createDataFrame(rows, f"id {kind}, v int"), name, "id", range_size=2)
        assert changed == W.Changed(len(want.keys() & {r[0] for r in rows[:5]}), len(rows))
        want.update(rows[:5])
        no_key += len(rows) - 5
        got = spark.table(name)
        assert sorted(tuple(r) for r in got.where("id IS NOT NULL").select("id", "v").collect()) == sorted(want.items())
        assert got.where("id IS NULL").count() == no_key
    kept = W._properties(spark, name)
    assert int(kept[W.ROWS]) == len(want) + no_key
    if kind == "string":  # as many parts as rows ask for, and each row where its key is looked for
        assert int(kept[W.PARTS]) >= len(want) // 2
        placed = W._with_part(got.withColumnRenamed(W.PART_COLUMN, "is"), "id", 2, int(kept[W.PARTS]))
        assert placed.where(F.col("is") != F.col(W.PART_COLUMN)).count() == 0


def test_a_part_that_gives_all_its_rows_away_is_emptied(spark):
    def rows(*span):
        return spark.range(*span).select(F.concat(F.lit("k"), "id").alias("id"), F.col("id").alias("v"))

    W.upsert(rows(1), "sk4.u", "id", range_size=1)
    for n in range(1, 12):
        W.upsert(rows(n, n + 1), "sk4.u", "id")
    assert held(spark, "sk4.u", "v") == sorted(((i,) for i in range(12)), key=str)


def test_hash_parts_find_their_parent():
    for parts in range(1, 70):
        for more in range(parts, 2 * parts + 1):
            for h in range(256):
                def at(n):
                    whole = 1 << (n - 1).bit_length()
                    return h % whole if h % whole < n else h % whole - whole // 2
                old, new = at(parts), at(more)
                assert new == old if new < parts else W._parent(new, parts) == old


class Died(Exception):
    pass


#: A function of the sinks and when it fails: after a change is noted, after it is written, and before it is noted as done.
POINTS = {
    "noted": ("_partitions", lambda spark, table, values: bool(W._properties(spark, table).get(W.PENDING))),
    "written": ("_check", lambda spark, table, values: True),
    "checked": ("_set_properties", lambda spark, table, values: values.get(W.PENDING) == ""),
}


@pytest.mark.parametrize("point", POINTS)
@pytest.mark.parametrize("sink", ["upsert", "days"])
def test_a_run_that_dies_is_finished_by_the_next(spark, monkeypatch, point, sink):
    """And a batch of a stream that comes again changes nothing, wherever the first run died."""
    name = f"sk5_{point}_{sink}.t"

    def put(rows, number):
        batch = spark.createDataFrame(rows, "id string, day string, v int")
        once = W.Batch("s", number)
        return W.upsert(batch, name, "id", range_size=2, once=once) if sink == "upsert" else W.replace_days(batch, name, "day", once=once)

    first = [(f"k{i}", f"2024-01-0{i % 4 + 1}", 0) for i in range(8)] + [(None, None, 0)]
    second = [("k1", "2024-01-02", 1), ("k9", "2024-01-02", 1), (None, None, 1)]
    put(first, 0)
    function, when = POINTS[point]
    real = getattr(W, function)

    def dies(spark_, table, *others, **values):
        if when(spark_, table, values):
            raise Died
        return real(spark_, table, *others, **values)

    with monkeypatch.context() as patched:
        patched.setattr(W, function, dies)
        with pytest.raises(Died):
            put(second, 1)
    assert len(leftovers(spark, name.split(".")[0])) == 1  # the rows to write wait
    assert not put(second, 1)
    key = {"upsert": "id", "days": "day"}[sink]
    before, batch = (spark.createDataFrame(r, "id string, day string, v int") for r in (first, second))
    want = sorted((tuple(r) for r in pure.upsert(before, batch, key).select("id", "day", "v").collect()), key=str)
    assert held(spark, name, "id", "day", "v") == want
    assert not put(second, 1) and not put(first, 0) and held(spark, name, "id", "day", "v") == want
    assert not leftovers(spark, name.split(".")[0])


def test_a_table_that_lost_rows_is_an_error(spark):
    W.replace_days(spark.range(10).select("id", F.lit("a").alias("day")), "sk6.d", "day")
    content = W._written_beside(spark.range(3).select("id", F.lit("b").alias("day")), "sk6.d")
    with pytest.raises(W.RowsLost, match="lost day=c"):
        W._check(spark, "sk6.d", "day", spark.table(content), {"day=c"})
    with pytest.raises(W.RowsLost, match="0 rows instead of 3"):
        W._check(spark, "sk6.d", "day", spark.table(content), {"day=a"})


@pytest.mark.parametrize("sink", ["refresh", "upsert", "days"])
def test_a_batch_is_read_once(spark, sink):
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    def put(n):
        batch = spark.range(n).selectExpr("id", "cast(id % 5 as string) day").mapInArrow(counting, "id long, day string")
        if sink == "refresh":
            return W.full_refresh(batch, "sk7.r")
        return W.upsert(batch, "sk7.u", "id", range_size=10) if sink == "upsert" else W.replace_days(batch, "sk7.d", "day")

    for n in (100, 40, 0):
        read.value = 0
        assert put(n).rows_written == n
        assert read.value == n


def test_types_are_those_of_the_table(spark):
    W.upsert(spark.createDataFrame([(1, "2024-01-01", 5)], "id bigint, day string, v bigint"), "sk8.u", "id")
    W.upsert(spark.createDataFrame([(2, 7)], "id int, v int"), "sk8.u", "id")
    assert held(spark, "sk8.u", "id", "day", "v") == [(1, "2024-01-01", 5), (2, None, 7)]
    with pytest.raises(Exception, match="no bigint for v: many"):
        W.upsert(spark.createDataFrame([(2, "many")], "id int, v string"), "sk8.u", "id")
    assert held(spark, "sk8.u", "id", "v") == [(1, 5), (2, 7)] and not leftovers(spark, "sk8")
    with pytest.raises(ValueError, match="another type of key"):
        W.upsert(spark.createDataFrame([("x", 7)], "id string, v int"), "sk8.u", "id")
    spark.range(3).write.saveAsTable("sk8.other")
    with pytest.raises(ValueError, match="not made by upsert"):
        W.upsert(spark.range(3), "sk8.other", "id")


def test_an_empty_batch_keeps_what_is_published(spark):
    W.full_refresh(spark.range(5), "sk9.r")
    assert not W.full_refresh(spark.range(0), "sk9.r") and spark.table("sk9.r").count() == 5
    assert W.full_refresh(spark.range(7), "sk9.r") == W.Changed(5, 7)
    assert W.full_refresh(spark.range(0), "sk9.r", keep_on_empty=False) == W.Changed(7, 0)
    assert W.full_refresh(spark.range(1), "sk9.new", keep_on_empty=True) == W.Changed(0, 1)


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_a_table_is_cut_into_no_more_than_the_most_parts(spark, monkeypatch, kind):
    """Far apart or dense, with or without a key: parts are longer where there would be too many, and later batches find them."""
    monkeypatch.setattr(W, "MOST_PARTS", 6, raising=False)
    name = f"sk9_{kind}.u"
    keys = [*range(-40, 200), 10**15, -(2**63), 2**63 - 1]

    def rows(some, v):
        return spark.createDataFrame([(str(k) if kind == "string" else k, v) for k in some] + [(None, v)], f"id {kind}, v int")

    assert W.upsert(rows(keys, 0), name, "id", range_size=2) == W.Changed(0, len(keys) + 1)
    assert len(W._partitions(spark, name)) <= 6 + 1  # and the part of rows without a key
    assert W.upsert(rows([7, 10**15, 10**15 + 1], 1), name, "id", range_size=2) == W.Changed(2, 4)
    want = [(str(k), int(k in (7, 10**15, 10**15 + 1))) for k in [*keys, 10**15 + 1]] + [(None, 0), (None, 1)]
    got = [(None if r.id is None else str(r.id), r.v) for r in spark.table(name).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert len(W._partitions(spark, name)) <= 6 + 1 and not leftovers(spark, f"sk9_{kind}")


def test_ranges_without_rows_make_no_range_longer(spark):
    apart = spark.createDataFrame([(k * 10**12, 0) for k in range(20)], "id bigint, v int")
    assert W._range_for(apart, "id", 5) == 5
