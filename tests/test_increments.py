"""Results that grow by a day or a session zone that differs: same answers, less work."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from funnelloom.functions.dates import local_date_tz
from funnelloom.operators import bitmaps, rollup
from funnelloom.operators.scans import scan_leads
from funnelloom.sources.testdata import AS_OF, Tables

KEYS = ["country", "source_id"]


@pytest.fixture(scope="module")
def leads(spark):
    rows = scan_leads(Tables(spark, "/root/testdata/sf0.001").leads, AS_OF)
    # A third of all rows on one asset, and asset numbers in several blocks.
    skewed = F.when(F.col("deal_id") % 3 == 0, 70_000).otherwise(F.col("asset_id") * 40_009)
    return rows.withColumn("asset_id", F.when(F.col("asset_id").isNotNull(), skewed)).cache()


def rows_of(df):
    return sorted(tuple(r) for r in df.select("g", *KEYS, "p", "tr", "t").collect())


def test_bitmaps_equal_the_flag_method(leads):
    by_bitmap = bitmaps.distinct_by_grain(bitmaps.day_bitmaps(leads, KEYS), KEYS)
    by_flag = rollup.cohort_by_grain(leads, {}, name=None)
    assert rows_of(by_bitmap) == rows_of(by_flag)


def test_one_day_more_costs_that_day(spark, leads, tmp_path):
    last = leads.agg(F.max("created")).first()[0]
    before, new = leads.where(F.col("created") < F.lit(last)), leads.where(F.col("created") == F.lit(last))
    schema = bitmaps.day_bitmaps(leads, KEYS).schema
    store = bitmaps.DayStore(spark, f"{tmp_path}/days", schema)
    store.put_all(bitmaps.day_bitmaps(before, KEYS))
    old = {p: p.stat().st_mtime_ns for p in (tmp_path / "days").rglob("*.parquet")}
    store.put(bitmaps.day_bitmaps(new, KEYS), last)
    store.put(bitmaps.day_bitmaps(new, KEYS), last)  # a day that is loaded again
    assert all(p.stat().st_mtime_ns == t for p, t in old.items())
    assert rows_of(bitmaps.distinct_by_grain(store.read(), KEYS)) == rows_of(rollup.cohort_by_grain(leads, {}, name=None))


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_local_day_does_not_depend_on_the_session(spark, zone):
    kept = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(
            "SELECT TIMESTAMP_NTZ '2026-05-10 04:59:59' AS wall, timestamp_micros(1778389199000000) AS instant, DATE '2026-05-10' AS day"
        )
        days = [local_date_tz(c, df.schema[c].dataType, "America/Bogota").cast("string").alias(c) for c in df.columns]
        assert tuple(df.select(*days).first()) == ("2026-05-09", "2026-05-09", "2026-05-09")
        later = spark.sql("SELECT TIMESTAMP_NTZ '2026-05-10 05:00:00' AS wall, timestamp_micros(1778389200000000) AS instant")
        days = [local_date_tz(c, later.schema[c].dataType, "America/Bogota") for c in later.columns]
        assert tuple(later.select(*days).first()) == (dt.date(2026, 5, 10),) * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)
