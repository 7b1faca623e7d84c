"""Specs, readers, writers and nested data."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwright import schemas
from layerwright.operators import nested as N
from layerwright.plans import gold
from layerwright.sources import ingest as G
from layerwright.sources import readers as R
from layerwright.sources import specs as S
from layerwright.sources import writers as W

RUN = dt.date(2024, 3, 1)
CONFIG = {
    "name": "main", "origin_db_connection": "a", "destination_db_connection": "b", "catchup": False,
    "start_date": "2024-01-01",
    "extractions": {
        "kinds": {"extraction_schema": "public", "ingestion_type": "full_refresh", "destination_schema": "raw"},
        "people": {
            "extraction_schema": "public", "ingestion_type": "incremental", "destination_schema": "raw",
            "incremental_filter": "updated_at >= '{{ macros.ds_add(ds, -1) }}' and updated_at < '{{ macros.ds_add(ds, 2) }}'",
            "exclude_columns": ["EMAIL", "absent"],
        },
    },
}


def test_spec(tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(CONFIG))
    (tmp_path / "b.txt").write_text("no spec")
    (spec,) = S.load_specs(tmp_path)
    assert (spec.name, spec.catchup, spec.start_date) == ("main", False, dt.date(2024, 1, 1))
    assert spec.by_table["kinds"].predicate(RUN) is None
    assert spec.by_table["people"].predicate(RUN) == "updated_at >= '2024-02-29' and updated_at < '2024-03-03'"
    assert S.fill_run_date("c >= '{{ ds }}' and c < '{{macros.ds_add(ds,1)}}'", RUN) == (
        "c >= '2024-03-01' and c < '2024-03-02'")
    with pytest.raises(ValueError):
        S.fill_run_date("{{ other }}", RUN)
    with pytest.raises(ValueError):
        S.Extraction("x", "sometimes")
    with pytest.raises(ValueError):
        S.Extraction("x", "incremental")


def test_extract(spark):
    people = spark.createDataFrame(
        [(i, f"m{i}", dt.datetime(2024, 2, 28) + dt.timedelta(days=i)) for i in range(6)],
        "id int, email string, updated_at timestamp_ntz",
    )
    got = R.extract(people, S.parse_spec(CONFIG).by_table["people"], RUN)
    assert got.columns == ["id", "updated_at"]
    assert sorted(r.id for r in got.collect()) == [1, 2, 3]


def test_visit_pages(spark, tmp_path):
    pages = [
        [{"idVisit": 1, "serverDate": "2024-01-01", "actions": 1, "actionDetails": [{"url": "ã"}], "extra": 1}],
        [{"idVisit": 2, "serverDate": "2024-01-02", "actions": 2}], [],
    ]
    for i, page in enumerate(pages):
        (tmp_path / f"p{i}.json").write_text(json.dumps(page, ensure_ascii=False, indent=1))
    rows = R.visit_pages(spark, str(tmp_path)).collect()
    got = {r.idVisit: r.actionDetails for r in rows}
    assert json.loads(got.pop(1)) == [{"url": "ã"}]
    assert got == {2: None}
    assert {r.idVisit: r.other_fields for r in rows} == {1: '{"extra":"1"}', 2: None}
    (tmp_path / "broken.json").write_text('[{"idVisit": 3}, {"idVisit"')
    with pytest.raises(R.BrokenPage, match="broken.json"):
        R.visit_pages(spark, str(tmp_path))
    with pytest.raises(ValueError, match="bounds"):
        R.jdbc_table(spark, "jdbc:none", "t", "id")


def test_pages_of_nodes_in_any_order(spark):
    def page(ids, more, cursor):
        return json.dumps({"data": {"component": {"proposals": {
            "pageInfo": {"hasNextPage": more, "endCursor": cursor}, "nodes": [{"id": i} for i in ids]}}}})

    bodies = [page([3], False, "z"), page([1, 2], True, "b")]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    nodes = R.pages_of_nodes(df, "body", "data.component.proposals", "id int")
    assert sorted(r.id for r in nodes.collect()) == [1, 2, 3]
    cursors = df.select(R.next_cursor(F.col("body"), "data.component.proposals")).collect()
    assert [c[0] for c in cursors] == [None, "b"]


def test_components_of_any_number_of_spaces(spark):
    draw = random.Random(11)
    for kinds in range(1, 5):
        wanted, frames, number = set(), [], 0
        for _ in range(kinds):
            spaces = []
            for _ in range(draw.randint(0, 4)):
                held = []
                for _ in range(draw.randint(0, 3)):
                    number += 1
                    held.append({"id": number, "__typename": draw.choice(["Kiosk", "Forum", "Survey"])})
                    if held[-1]["__typename"] != "Survey":
                        wanted.add(number)
                spaces.append((held,))
            frames.append(spark.createDataFrame(spaces, "components array<struct<id:int,__typename:string>>"))
        got = R.components_of_type(frames, ["Kiosk", "Forum"]).collect()
        assert {r.id for r in got} == wanted and len(got) == len(wanted)
    with pytest.raises(ValueError):
        R.components_of_type([], ["Kiosk"])


def test_unnest(spark):
    values = ['[{"a":"12","b":"x"},{"a":7}]', "[]", None, '{"a":"5"}', '[{"a":"z"}]']
    df = spark.createDataFrame(list(enumerate(values)), "i int, j string")
    rows = N.unnest_json_array(df, "j", {"a": "int", "b": "string"}).select("i", "item.a", "item.b").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [(0, 12, "x"), (0, 7, None), (1, None, None), (2, None, None), (3, 5, None), (4, None, None)], key=str)


BROKEN = {  # text: elements that are read, and rejects
    '[{"a":"1"},{"a":"2"},{"a":"3': (["1", "2"], [(3, '{"a":"3')]),
    '[{"a":"1"},{"a":"2"},{"a"': (["1", "2"], [(3, '{"a"')]),
    ' [{"a":"1"} , {"a":"2"},': (["1", "2"], []),
    '[{"a":"1"},{"a":"2"}': (["1", "2"], []),
    '[{"a":"1"},7,"x,y",{"a":"2"}]': (["1", "2"], [(2, "7"), (3, '"x,y"')]),
    '[{"a":"1"},{b},{"a":"2"}] junk': (["1", "2"], [(2, "{b}")]),
    r'[{"a":"]},\\"{"},{"a":{"b":[1,{"c":2}]}},{"a":}]': ([']},"{', '{"b":[1,{"c":2}]}'], [(3, '{"a":}')]),
    "x": ([], [(1, "x")]),
    '{"a": "5"': ([], [(1, '{"a": "5"')]),
    "[": ([], []),
    "": ([], []),
    " ": ([], []),
}


def test_broken_arrays_keep_their_good_elements(spark):
    texts = [t.replace("\\\\", "\\") for t in BROKEN]
    df = spark.createDataFrame(list(enumerate([*texts, None, '[{"a":"z"}]'])), "i int, j string")
    got: dict = {}
    for r in N.unnest_json_array(df, "j", {"a": "string"}).collect():
        got.setdefault(r.i, []).append(r.item.a)
    rejects: dict = {}
    for r in N.json_rejects(df, "j").collect():
        rejects.setdefault(r.i, []).append((r.place, r.element))
    for i, (values, bad) in enumerate(BROKEN.values()):
        assert got[i] == (values or [None]) and sorted(rejects.get(i, [])) == bad, texts[i]
    assert got[len(texts)] == [None] and got[len(texts) + 1] == ["z"] and max(rejects) < len(texts)


def test_flatten_and_find(spark):
    df = spark.createDataFrame([((1, (2, (3,))),)], "r struct<a:int,b:struct<c:int,d:struct<e:int>>>")
    assert N.flatten_structs(df).columns == ["r.a", "r.b.c", "r.b.d.e"]
    schema = df.schema["r"].dataType
    assert [N.paths_of_key(schema, k) for k in ("b", "x", "e", "f")] == [["b"], [], ["b.d.e"], []]
    assert df.select(N.value_of_key(df, "e"), N.value_of_key(df, "x")).first()[:] == (3, None)
    two = spark.createDataFrame([((None,), (5, 6))], "first struct<k:int>, second struct<k:int,m:int>")
    assert two.select(N.value_of_key(two, "k"), N.value_of_key(two, "m")).first()[:] == (5, 6)


def test_nested_to_json(spark):
    df = spark.createDataFrame([(1, ("ã", None), [1, 2], {"k": 1})], "i int, s struct<a:string,b:int>, l array<int>, m map<string,int>")
    assert N.nested_to_json(df).first().asDict() == {"i": 1, "s": '{"a":"ã","b":null}', "l": "[1,2]", "m": '{"k":1}'}


def test_layer_names_and_schemas(spark):
    assert schemas.layer_database("prod", " silver ") == "silver"
    assert schemas.layer_database("dev", "silver") == "dev_silver"
    assert schemas.layer_database("dev", None) == "dev"
    users = spark.createDataFrame([(1, "n")], "id bigint, nickname string")
    full = schemas.add_missing_columns(users, schemas.bronze_schema("decidim_users"))
    assert set(full.columns) == set(schemas.bronze_schema("decidim_users").fieldNames())
    assert isinstance(full.schema["updated_at"].dataType, T.TimestampNTZType)
    assert len(schemas.BRONZE_DDL) == 16


def table_rows(spark, name, *cols):
    return sorted(tuple(r) for r in spark.table(name).select(*cols).collect())


def test_full_refresh(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert W.full_refresh(df, "w1.t")
    assert W.full_refresh(df.where("id = 2"), "w1.t")
    assert table_rows(spark, "w1.t", "id") == [(2,)]
    assert not W.full_refresh(df.limit(0), "w1.t")
    assert table_rows(spark, "w1.t", "id") == [(2,)]
    assert W.full_refresh(df.where("false"), "w1.t", keep_on_empty=False)
    assert table_rows(spark, "w1.t", "id") == []
    assert spark.sql("SHOW TABLES IN w1").count() == 3  # the view, the table behind it and the one before
    df.write.saveAsTable("w1.plain")
    assert W.full_refresh(df.where("id = 1"), "w1.plain")
    assert table_rows(spark, "w1.plain", "id") == [(1,)]


def test_columns_the_table_lacks_are_an_error(spark):
    df = spark.createDataFrame([(1, "2024-01-01")], "id int, day string")
    W.upsert(df, "w6.u", "id")
    W.replace_days(df, "w6.d", "day")
    more = df.withColumn("extra", F.lit(1))
    with pytest.raises(ValueError, match="extra"):
        W.upsert(more, "w6.u", "id")
    with pytest.raises(ValueError, match="extra"):
        W.replace_days(more, "w6.d", "day")


def test_upsert_rewrites_only_touched_ranges(spark):
    rows = [(i, f"v{i}") for i in range(100)]
    W.upsert(spark.createDataFrame(rows, "id bigint, v string"), "w2.t", "id", range_size=10)
    before = {r.f for r in spark.table("w2.t").select(F.input_file_name().alias("f")).where("_key_part <> 'p2'").collect()}
    batch = spark.createDataFrame([(25, "new"), (26, "new")], "id bigint, v string")
    assert W.upsert(batch, "w2.t", "id", range_size=10)
    expected = sorted((i, "new" if i in (25, 26) else f"v{i}") for i in range(100))
    assert table_rows(spark, "w2.t", "id", "v") == expected
    after = {r.f for r in spark.table("w2.t").select(F.input_file_name().alias("f")).where("_key_part <> 'p2'").collect()}
    assert before == after
    assert W.upsert(batch, "w2.t", "id", range_size=10)
    assert table_rows(spark, "w2.t", "id", "v") == expected
    assert not W.upsert(batch.limit(0), "w2.t", "id")


def test_upsert_by_text_key(spark):
    W.upsert(spark.createDataFrame([("a", 1), ("b", 1)], "uuid string, v int"), "w4.t", "uuid")
    W.upsert(spark.createDataFrame([("b", 2), ("c", 2)], "uuid string, v int"), "w4.t", "uuid")
    assert table_rows(spark, "w4.t", "uuid", "v") == [("a", 1), ("b", 2), ("c", 2)]


def test_ingestion_runs(spark, tmp_path):
    def people(*rows):
        return spark.createDataFrame(
            [(i, f"m{i}", n, dt.datetime(2024, 3, d)) for i, n, d in rows], "id int, email string, n string, updated_at timestamp_ntz")

    kinds = spark.createDataFrame([(1, ["x"])], "id int, tags array<string>")
    config = {**CONFIG, "extractions": {**CONFIG["extractions"], "broken": CONFIG["extractions"]["kinds"]}}
    config["extractions"] = {n: {**e, "destination_schema": "w5"} for n, e in config["extractions"].items()}
    spec = S.parse_spec(config)

    def run(day, rows):
        sources = {"kinds": kinds, "people": people(*rows)}
        return G.ingest_spec(spec, lambda e: sources[e.table], dt.date(2024, 3, day))

    with pytest.raises(G.IngestionFailed, match="broken") as first:
        run(1, [(1, "a", 1), (2, "b", 2), (3, "late", 9)])
    assert isinstance(first.value.failed["broken"], KeyError)
    assert (first.value.done["kinds"], first.value.done["people"]) == (W.Changed(0, 1), W.Changed(0, 2))
    spec = S.parse_spec({**config, "extractions": {n: e for n, e in config["extractions"].items() if n != "broken"}})
    assert run(3, [(2, "B", 3), (4, "d", 4)])["people"] == W.Changed(1, 2)
    assert not run(20, [(2, "never", 3)])["people"]
    assert table_rows(spark, "w5.people", "id", "n") == [(1, "a"), (2, "B"), (4, "d")]
    assert "email" not in spark.table("w5.people").columns
    assert table_rows(spark, "w5.kinds", "id", "tags") == [(1, '["x"]')]

    for i, page in enumerate([[{"idVisit": 1, "serverDate": "2024-01-01"}, {"idVisit": 2, "serverDate": "2024-01-02"}], []]):
        (tmp_path / f"a{i}.json").write_text(json.dumps(page))
    assert G.ingest_visits(spark, str(tmp_path), "w5.visits")
    assert G.ingest_visits(spark, str(tmp_path), "w5.visits")
    assert table_rows(spark, "w5.visits", "idVisit") == [(1,), (2,)]


def test_replace_days(spark):
    schema = "idVisit int, serverDate string, actionDetails array<string>"
    W.replace_days(spark.createDataFrame([(1, "2024-01-01", ["x"]), (2, "2024-01-02", [])], schema), "w3.v")
    W.replace_days(spark.createDataFrame([(3, "2024-01-02", ["y"]), (4, "2024-01-03", None)], schema), "w3.v")
    assert table_rows(spark, "w3.v", "idVisit", "serverDate") == [
        (1, "2024-01-01"), (3, "2024-01-02"), (4, "2024-01-03")]
    assert not W.replace_days(spark.createDataFrame([], schema), "w3.v")


def test_rows_without_key_or_day_stay(spark):
    first = spark.createDataFrame([(1, "a"), (None, "old"), (2, "b")], "id bigint, v string")
    assert W.upsert(first, "w7.u", "id") == W.Changed(0, 3)
    assert W.upsert(spark.createDataFrame([(1, "A"), (None, "new")], "id bigint, v string"), "w7.u", "id") == W.Changed(1, 2)
    assert sorted(r.v for r in spark.table("w7.u").collect()) == ["A", "b", "new", "old"]
    text = first.selectExpr("cast(id as string) as id", "v")
    assert W.upsert(text, "w7.t", "id") == W.Changed(0, 3)
    assert W.upsert(text.where("v <> 'b'"), "w7.t", "id") == W.Changed(1, 2)
    assert sorted(r.v for r in spark.table("w7.t").collect()) == ["a", "b", "old", "old"]
    days = spark.createDataFrame([(1, "2024-01-01"), (2, None)], "i int, day string")
    assert W.replace_days(days, "w7.d", "day") == W.Changed(0, 2)
    assert W.replace_days(spark.createDataFrame([(3, None), (4, "2024-01-01")], "i int, day string"), "w7.d", "day") == W.Changed(1, 2)
    assert table_rows(spark, "w7.d", "i") == [(2,), (3,), (4,)]
    assert not [r for r in spark.sql("SHOW TABLES IN w7").collect() if "staged" in r.tableName]


def test_repeated_keys_of_a_batch_are_all_added(spark):
    W.upsert(spark.createDataFrame([(1, "a")], "id int, v string"), "w8.u", "id")
    assert W.upsert(spark.createDataFrame([(1, "b"), (1, "c")], "id int, v string"), "w8.u", "id") == W.Changed(1, 2)
    assert table_rows(spark, "w8.u", "v") == [("b",), ("c",)]


def test_hash_parts_grow_with_the_table(spark):
    def rows(*span):
        return spark.range(*span).select(F.concat(F.lit("k"), "id").alias("id"), F.col("id").alias("v"))

    W.upsert(rows(0, 40), "w9.u", "id", range_size=10)
    assert W._properties(spark, "w9.u")[W.PARTS] == "4"
    assert W.upsert(rows(20, 100), "w9.u", "id") == W.Changed(20, 80)
    assert W._properties(spark, "w9.u")[W.PARTS] == "10" and W._properties(spark, "w9.u")[W.ROWS] == "100"
    assert W.upsert(rows(0, 10), "w9.u", "id") == W.Changed(10, 10)
    assert table_rows(spark, "w9.u", "v") == [(i,) for i in range(100)]


def test_files_of_a_part_are_few(spark):
    batch = spark.range(0, 2000, 1, 8).select(((F.col("id") * 7919) % 2000).alias("id"), F.lit("v").alias("v"))
    W.upsert(batch, "w10.u", "id", range_size=100)
    W.upsert(batch.where("id < 1000"), "w10.u", "id")
    files = spark.table("w10.u").select(W.PART_COLUMN, F.input_file_name().alias("f")).distinct().groupBy(W.PART_COLUMN).count()
    assert files.count() == 20 and files.agg(F.max("count")).first()[0] <= 2


def test_versions_of_other_names_and_runs_are_left_alone(spark):
    df = spark.range(3)
    W.full_refresh(df, "w11.users")
    df.write.saveAsTable("w11.users__notes")
    W.full_refresh(df, "w11.users__more")
    pending = W.new_version(df, "w11.users")
    for n in range(4):
        assert W.full_refresh(spark.range(n + 1), "w11.users").rows_written == n + 1
    names = {r.tableName for r in spark.sql("SHOW TABLES IN w11").collect()}
    assert {"users", "users__notes", "users__more", pending.split(".")[1]} <= names
    assert len([n for n in names if n.startswith("users__") and W._properties(spark, f"w11.{n}").get(W.VERSION_OF) == "w11.users"]) == 3
    assert spark.table("w11.users").count() == 4 and spark.table("w11.users__more").count() == 3
    assert W.full_refresh(df, "w11.users") == W.Changed(4, 3)


def test_publish(spark):
    df = spark.range(20).select("id", F.lit("2024-01").alias("month"))
    name = W.publish_table(df, "m", "dev", "gold", ["id"], ["month"])
    assert name == "dev_gold.m" and spark.table(name).count() == 20
    assert spark.table(W.publish_view(df, "m_view")).count() == 20


def test_bucketed_tables_join_in_place(spark):
    df = spark.range(1000).select("id", (F.col("id") * 2).alias("v"))
    a = W.publish_table(df, "ba", "dev", "gold", bucket_by=["id"], buckets=4)
    b = W.publish_table(df, "bb", "dev", "gold", bucket_by=["id"], buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(a).join(spark.table(b), "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows_scanned(df):
    """Rows that the scans of a plan gave out, which leaves skipped row groups out."""
    df.collect()
    scans, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif node.getClass().getSimpleName() == "FileSourceScanExec":
            scans += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return scans


def test_an_index_reads_few_rows(spark):
    df = spark.range(0, 200_000, 1, 8).select(((F.col("id") * 7919) % 50_000 * 2).alias("k"), F.col("id").alias("v"))
    plain = W.publish_table(df, "ix_plain", "dev", "gold")
    indexed = W.publish_table(df, "ix", "dev", "gold", ["v"], index_by=["k"])
    look_up = {name: spark.table(name).where("k = 31338") for name in (plain, indexed)}
    assert look_up[plain].count() == look_up[indexed].count() == 4
    assert rows_scanned(look_up[plain]) == 200_000 and rows_scanned(look_up[indexed]) <= 50_000
    # A number that is inside the ranges and is not there is told by the filters alone.
    assert rows_scanned(spark.table(plain).where("k = 31339")) == 200_000 and rows_scanned(spark.table(indexed).where("k = 31339")) == 0
    with pytest.raises(ValueError, match="buckets"):
        W.publish_table(df, "ix", "dev", "gold", index_by=["k"], partition_by=["v"])


@pytest.mark.parametrize("values", [[1] * 90 + list(range(10)), list(range(100)), [5] * 10, [None, 3, None], [], ["a", "o'b", "c", "c", None]])
def test_ranges_follow_skewed_keys(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "k string" if "a" in values else "k int")
    df.createOrReplaceTempView("skewed_keys")
    cuts = [r.cut for r in spark.sql(R.cuts_query("skewed_keys", "k", 4)).collect()]
    predicates = R.range_predicates("k", cuts)
    counts = [df.where(p).count() for p in predicates]
    assert sum(counts) == len(values) and df.where(" OR ".join(f"({p})" for p in predicates)).count() == len(values)
    if values == list(range(100)):
        assert counts == [25, 25, 25, 25]
    if values[:2] == [1, 1]:  # equal steps would put 99 of 100 rows into one range as well as a hot value does; no range is empty
        assert min(counts) > 0 and len(counts) >= 2


@pytest.mark.parametrize("values", [[1] * 90 + list(range(10)), list(range(100)), [5] * 10, [None, 3, None], [], ["a", "o'b", "c", "c", None],
                                    [i * i % 61 for i in range(150)], [2**60, -2**60, 0, 0, 1]])
def test_cuts_of_counted_keys_need_no_window_over_all_rows(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "k string" if "a" in values else "k bigint")
    df.createOrReplaceTempView("all_keys")
    counted = R.counted_keys(df, "k")
    stretches = counted.groupBy("stretch").agg(F.min("k").alias("a"), F.max("k").alias("z")).orderBy("stretch").collect()
    assert all(x.z < y.a for x, y in zip(stretches, stretches[1:]))
    counted.createOrReplaceTempView("counted_keys")
    # Stretches of one key each, to cross them whatever Spark makes of few rows.
    counted.withColumn("stretch", F.expr("dense_rank() OVER (ORDER BY k)")).createOrReplaceTempView("short_stretches")
    for parts in (1, 2, 4, 7, 200):
        want = [r.cut for r in spark.sql(R.cuts_query("all_keys", "k", parts)).collect()]
        for view in ("counted_keys", "short_stretches"):
            assert [r.cut for r in spark.sql(R.cuts_query(view, "k", parts, counted=True)).collect()] == want
    plan = spark.sql(R.cuts_query("counted_keys", "k", 4, counted=True))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("windowspecdefinition(stretch") == 2 and "ntile" not in plan


def test_sketches_add_up(spark):
    visits = spark.range(60_000).select(
        F.format_string("2024-01-%02d", F.col("id") % 20 + 1).alias("session_date"), (F.col("id") % 3).cast("string").alias("proposal_id"),
        (F.col("id") % 9_000).alias("session_id"))
    sketches = gold.visit_sketches(visits.unionByName(visits.withColumn("proposal_id", F.lit("none"))))
    assert sketches.count() == 60
    for first, last in (("2024-01-01", "2024-01-20"), ("2024-01-03", "2024-01-09")):
        exact = {r.proposal_id: r.n for r in visits.where(f"session_date BETWEEN '{first}' AND '{last}'").groupBy("proposal_id").agg(
            F.count_distinct("session_id").alias("n")).collect()}
        for r in gold.visits_between(sketches, first, last).collect():
            assert abs(r.visits - exact[str(r.proposal_id)]) <= 0.065 * exact[str(r.proposal_id)]
