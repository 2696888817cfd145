"""Boards on tables in which one key holds a third of all rows, with broadcasts off and
skew handling forced, against plain SQL joins on the same tables."""

import duckdb
import pytest
from parity import TABLES, compare, connect

from __spark_entry__ import oracle_sql, queries

SOURCE = "/root/testdata/sf0.001"
# A third of each table moves to one asset, deal, part or visitor.
REWRITES = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE o_custkey END AS o_custkey)",
    "lineitem": "SELECT * REPLACE (CASE WHEN l_suppkey % 3 = 0 THEN 6 ELSE l_orderkey END AS l_orderkey, "
    "CASE WHEN l_suppkey % 3 = 1 THEN 3 ELSE l_partkey END AS l_partkey)",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 5 ELSE user_id END AS user_id)",
    "part": "SELECT * REPLACE (CASE WHEN p_partkey % 3 = 0 THEN 'Brand#4' ELSE p_brand END AS p_brand)",
}
BOARDS = (
    "sellers_funnel",
    "sellers_funnel_from_states",
    "transitory_states_from_states",
    "distinct_assets_by_bitmap",
    "range_sum_spend",
    "transitory_states",
    "assigned_explorer",
    "eligibility_flags_13",
    "dupont_daily",
    "weekly_by_channel",
    "weekly_by_platform",
    "price_quality_states",
    "web_form_funnel",
    "creative_vs_universe",
    "today_by_hour",
)
FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory, spark):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in TABLES:
        select = REWRITES.get(name, "SELECT *")
        con.execute(
            f"COPY ({select} FROM '{SOURCE}/{name}.parquet') TO '{folder}/{name}.parquet' (FORMAT parquet)"
        )
    before = {k: spark.conf.get(k, None) for k in FORCED}
    for key, value in FORCED.items():
        spark.conf.set(key, value)
    yield str(folder)
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.mark.parametrize("key", BOARDS)
def test_skewed_tables_give_whole_results(spark, skewed, key):
    _, _, problem = compare(spark, connect(skewed), key, queries()[key], oracle_sql()[key], skewed)
    assert problem is None, problem
