"""Plans that must hold at any size."""

from __future__ import annotations

import datetime as dt
import re

import pytest

from layerwright.acceptance import catalog
from layerwright.acceptance.tables import table
from layerwright.operators import joins as J
from layerwright.operators.dedup import latest_per_key
from layerwright.sources.readers import extract
from layerwright.sources.specs import Extraction


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cross_join_no_global_window_no_python(spark, sf_dir, name):
    plan = plan_of(catalog.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan
    # A nested loop is only right for a one-row side, which no query has.
    assert "BroadcastNestedLoopJoin" not in plan
    if not name.startswith("q_cdc"):
        assert "EvalPython" not in plan and "InPandas" not in plan and "InArrow" not in plan
    assert plan.count("ArrowEvalPython") <= 1
    for spec in re.findall(r"windowspecdefinition\(([^)]*)", plan):
        first = spec.split(",")[0]
        assert " ASC " not in first and " DESC " not in first, f"window without partition: {spec}"


def test_latest_version_is_cut_before_the_shuffle(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    plan = plan_of(latest_per_key(lines, ["l_orderkey"], "l_shipdate"))
    before, after = plan.split("Exchange", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    spec = Extraction("orders", "incremental", incremental_filter="o_orderdate >= '{{ ds }}'",
                      exclude_columns=("o_orderpriority", "o_totalprice"))
    plan = extract(table(spark, sf_dir, "orders"), spec, dt.date(1997, 1, 1))
    text = plan._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(o_orderdate" in text
    assert "o_totalprice" not in re.search(r"ReadSchema: .*", text).group()


def test_flagship_moves_activity_not_days(spark, sf_dir):
    plan = plan_of(catalog.QUERIES["q_daily_metrics"](spark, sf_dir))
    unfolding = plan.index("explode(sequence")
    assert "Exchange" not in plan[:unfolding], "days must be unfolded after the last exchange"


def test_small_sides_are_broadcast_by_size(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    dim = customer.withColumnRenamed("c_custkey", "o_custkey")
    assert "BroadcastHashJoin" in plan_of(J.spread_join(orders, dim, ["o_custkey"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert "SortMergeJoin" in plan_of(J.spread_join(orders, dim, ["o_custkey"]))
        many = plan_of(J.lookup_many(dim, orders, ["o_custkey"]))
        assert "LeftOuter" not in many and "Inner" in many and "LeftAnti" in many
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_copies_are_not_broadcast(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    for how in ("left", "inner", "left_semi", "left_anti"):
        joined = J.spread_join(orders, customer, ["o_custkey"], how, salt=8)
        joined.collect()  # the plan that was run, in the end
        assert "SortMergeJoin" in plan_of(joined) and "BroadcastExchange" not in plan_of(joined)


#: Queries that write a step, or a table that is their subject, while they are built; whole runs and streams do.
WRITING = ("q_cdc_", "q_change_", "q_comment_", "q_full_refresh", "q_gold_roundtrip", "q_dq_report", "q_upsert", "q_replace_", "q_ingest_", "q_key_ranges",
           "q_layer_tables", "q_indexed_lookup", "q_feed_run", "q_daily_counts_stream")


@pytest.mark.parametrize("name", sorted(n for n in catalog.QUERIES if not n.startswith(WRITING)))
def test_building_a_query_runs_nothing(spark, sf_dir, monkeypatch, name):
    kind = type(spark.range(1))

    def refuse(self, *args, **options):
        raise AssertionError("a query ran while it was built")

    for action in ("collect", "count", "first", "isEmpty", "toPandas", "take", "head"):
        monkeypatch.setattr(kind, action, refuse)
    catalog.QUERIES[name](spark, sf_dir)


def test_log_is_moved_once(spark, sf_dir):
    plan = plan_of(catalog.QUERIES["q_cdc_changes"](spark, sf_dir))
    main = plan.split("BroadcastExchange")[0]
    assert main.count("Exchange hashpartitioning") <= 1
