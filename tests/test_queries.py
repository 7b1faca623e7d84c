"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
import oracle
from layerwright.acceptance import catalog


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = oracle.connect(sf_dir)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    if name in catalog.SQL:
        assert oracle.differences(df, con, catalog.SQL[name]) == []
    else:
        assert df.count() >= 0


@pytest.mark.parametrize("name", [
    "q_proposals", "q_proposals_single", "q_votes", "q_visits", "q_dim_left_join", "q_proposal_metrics", "q_semi_join",
    "q_slug_join", "q_upsert_by_key", "q_replace_by_day", "q_dq_completeness", "q_dq_referential", "q_dq_self_reference",
    "q_split_known", "q_config_merge", "q_comment_threads", "q_cdc_poll_cut",
])
def test_large_side_ways_give_the_same(spark, sf_dir, con, name):
    """Nothing is broadcast and every task of more than a few bytes is split: the way taken by large data."""
    large = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    for key, value in large.items():
        spark.conf.set(key, value)
    try:
        assert oracle.differences(catalog.QUERIES[name](spark, sf_dir), con, catalog.SQL[name]) == []
    finally:
        for key in large:
            spark.conf.unset(key)


def test_entry_contract(spark):
    assert entry_module.entry(spark).limit(1).count() == 1
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert entry_module.FLAGSHIP in entry_module.oracle_sql()
