"""Plans that the boards must keep: what reaches the scan, what is shuffled how often."""

import re

import pytest

from funnelloom.plans import sellers
from funnelloom.sources.testdata import AS_OF, Tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The canonical tables as files of their own, as a user has them."""
    folder = tmp_path_factory.mktemp("canonical")
    tables, out = Tables(spark, FOLDER), {}
    for name in ("leads", "state_log", "stage_log", "deal_states", "state_catalogue"):
        getattr(tables, name).write.parquet(f"{folder}/{name}")
        out[name] = spark.read.parquet(f"{folder}/{name}")
    return out


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def log_scans(text):
    return [line for line in text.splitlines() if "FileScan" in line and "/state_log" in line]


def test_with_a_state_table_only_deciding_log_rows_are_read(stored):
    t = stored
    boards = (
        sellers.sellers_funnel(t["leads"], t["state_log"], t["stage_log"], AS_OF, t["deal_states"]),
        sellers.mm_without_inmo(t["leads"], t["state_log"], t["state_catalogue"], AS_OF, t["deal_states"]),
        sellers.transitory_states(t["leads"], t["state_log"], AS_OF, t["deal_states"]),
    )
    for df in boards:
        scans = log_scans(plan(df))
        assert scans and all(re.search(r"PushedFilters: \[[^\]]*state_id", s) for s in scans)
    anti = sellers.antifunnel(t["leads"], t["state_log"], t["state_catalogue"], AS_OF, t["deal_states"])
    assert log_scans(plan(anti)) == []


def test_assignment_meets_grouped_rows_and_shares_their_shuffle(stored, no_broadcast):
    t = stored
    text = plan(sellers.sellers_funnel(t["leads"], t["state_log"], t["stage_log"], AS_OF)).split("Initial Plan")[0]
    # The window over an asset's days needs no exchange of its own: the join below it has one.
    between = text[text.index("Window [lag") : text.index("SortMergeJoin [country")]
    assert "Exchange" not in between
    # Leads once by deal, grouped rows once by all keys and once by asset.
    assert len(re.findall(r"Exchange hashpartitioning\(country#\d+, source_id#\d+, source_name#\d+, created#\d+, asset_id#\d+L?", text)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(country#\d+, asset_id#\d+L?, \d+\)", text)) <= 3
