"""Board of the running day: hour by hour against last week and the last four weekdays."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelloom.functions.dates import local_date, local_hour
from funnelloom.functions.ratios import round_half_up
from funnelloom.functions.text import label_source
from funnelloom.operators.events import first_windowed_event
from funnelloom.operators.channels import per_country
from funnelloom.spec import LABELS_HOURLY, QUALIFIED_MM

DAYS = 40
METRICS = ("registros", "calificados")
# Sources shown per country.
SHOWN = {
    "CO": ("WEB", "Estudio", "Leadforms", "CRM", "Broker", "Comercial"),
    "MX": ("WEB", "Estudio", "Leadforms", "Propiedades", "Broker", "Comercial"),
}
# Days back of the four weekdays that make the average.
AVERAGE_OFFSETS = (14, 21, 28, 35)


def _since(now_utc: dt.datetime, days: int = DAYS) -> Column:
    return F.lit(f"{now_utc - dt.timedelta(days=days)}").cast("timestamp_ntz")


def local_now(now_utc: dt.datetime, offset: int) -> dt.datetime:
    return now_utc + dt.timedelta(hours=offset)


def labelled_leads(leads: DataFrame, now_utc: dt.datetime) -> DataFrame:
    return leads.where(
        (F.col("created_at") >= _since(now_utc))
        & F.col("deal_id").isNotNull()
        & F.col("source_id").isin(*LABELS_HOURLY)
    ).withColumn("source", label_source(F.col("source_id"), LABELS_HOURLY))


def _by_hour(rows: DataFrame, ts: str, metric: str) -> DataFrame:
    day = per_country(lambda s: local_date(F.col(ts), s.utc_offset))
    hour = per_country(lambda s: local_hour(F.col(ts), s.utc_offset))
    return (
        rows.groupBy("country", day.alias("local_date"), hour.alias("hour"), "source")
        .agg(F.count_distinct("deal_id").alias("n"))
        .withColumn("metric", F.lit(metric))
    )


def hourly_long(leads: DataFrame, log: DataFrame, now_utc: dt.datetime) -> DataFrame:
    """Distinct deals per metric, local day, local hour and source."""
    recent = labelled_leads(leads, now_utc)
    registered = _by_hour(recent, "created_at", "registros")
    first = first_windowed_event(log, QUALIFIED_MM, _since(now_utc))
    sources = recent.select("country", "deal_id", "source").distinct()
    qualified = _by_hour(first.join(sources, ["country", "deal_id"]), "first_at", "calificados")
    return registered.unionByName(qualified)


def hour_matrix(long: DataFrame, now_utc: dt.datetime) -> DataFrame:
    """24 hours per country, metric and shown source: today with future hours NULL, last
    week's day, and the mean of four weekdays in which a missing day counts as 0.

    One pass: each row is a conditional sum over the day's distance from today, and the
    hour spine comes from the fixed axis, not from the data.
    """
    spark = long.sparkSession
    heads = [(c, m, s) for c, sources in SHOWN.items() for m in METRICS for s in sources]
    axis = spark.createDataFrame(heads, "country string, metric string, source string").select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(24))).alias("hour")
    )
    today = per_country(lambda s: F.lit(local_now(now_utc, s.utc_offset).date()))
    open_hour = per_country(lambda s: F.lit(local_now(now_utc, s.utc_offset).hour + 1))
    age = F.datediff(today, F.col("local_date"))

    def on(*ages: int) -> Column:
        return F.coalesce(F.sum(F.when(age.isin(*ages), F.col("n"))), F.lit(0))

    sums = long.where(age.isin(0, 7, *AVERAGE_OFFSETS)).groupBy("country", "metric", "source", "hour")
    filled = axis.join(
        sums.agg(on(0).alias("now"), on(7).alias("prev"), on(*AVERAGE_OFFSETS).alias("four")),
        ["country", "metric", "source", "hour"],
        "left",
    )
    zero = F.lit(0)
    return filled.select(
        "country",
        "metric",
        "source",
        "hour",
        F.when(F.col("hour") <= open_hour, F.coalesce("now", zero)).alias("today"),
        F.coalesce("prev", zero).alias("prev_week"),
        (F.coalesce("four", zero).cast("double") / F.lit(4.0)).alias("avg_4"),
    )


def all_sources(matrix: DataFrame) -> DataFrame:
    """Hours over all shown sources; an hour without any value stays NULL."""
    return matrix.groupBy("country", "metric", "hour").agg(
        F.sum("today").alias("today"),
        F.sum("prev_week").alias("prev_week"),
        F.sum("avg_4").alias("avg_4"),
    )


def cumulative_by_hour(hours: DataFrame) -> DataFrame:
    """Running totals; NULL hours stay NULL."""
    w = Window.partitionBy("country", "metric").orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
    return hours.select(
        "country",
        "metric",
        "hour",
        *[F.when(F.col(c).isNotNull(), F.sum(c).over(w)).alias(c) for c in ("today", "prev_week", "avg_4")],
    )


def last_hour_with_data(hours: DataFrame) -> DataFrame:
    return hours.groupBy("country", "metric").agg(
        F.max(F.when(F.col("today") > 0, F.col("hour"))).alias("last_hour")
    )


def hourly_totals(matrix: DataFrame) -> DataFrame:
    """Day totals per source and for all sources."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("today", "prev_week", "avg_4")]
    each = F.explode(F.array(F.col("source"), F.lit("_all"))).alias("source")
    rows = matrix.select("country", "metric", "today", "prev_week", "avg_4", each)
    return rows.groupBy("country", "metric", "source").agg(*sums)


def pace_vs_average(hours: DataFrame) -> DataFrame:
    """Today so far against the mean up to the same hour, and the current hour's rate
    against its mean, in whole percent; 0 where the mean is 0."""
    so_far = F.col("today").isNotNull()
    last = F.max(F.when(so_far, F.col("hour")))
    sums = hours.groupBy("country", "metric").agg(
        F.coalesce(F.sum("today"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(so_far, F.col("avg_4"))), F.lit(0.0)).alias("avg_so_far"),
        last.alias("hour"),
        F.max_by("today", F.when(so_far, F.col("hour"))).alias("rate"),
        F.max_by("avg_4", F.when(so_far, F.col("hour"))).alias("avg_rate"),
    )

    def change(now: str, mean: str) -> Column:
        share = round_half_up((F.col(now) - F.col(mean)) / F.col(mean) * 100.0)
        return F.when(F.col(mean) > 0, share).otherwise(F.lit(0).cast("long"))

    return sums.select(
        "*",
        change("total", "avg_so_far").alias("pct_total"),
        change("rate", "avg_rate").alias("pct_rate"),
    )


def data_lag_hours(hours: DataFrame, now_utc: dt.datetime) -> DataFrame:
    """Current hour minus the earlier of the two metrics' last hours; NULL without data."""
    last = last_hour_with_data(hours).groupBy("country").agg(F.min("last_hour").alias("earliest"))
    now = per_country(lambda s: F.lit(local_now(now_utc, s.utc_offset).hour + 1))
    return last.select("country", "earliest", (now - F.col("earliest")).alias("lag_hours"))


def freshness(long_ts: DataFrame, ts: str, now_utc: dt.datetime, stale_minutes: int) -> DataFrame:
    """Age of the newest row in minutes, per country, and whether it is stale."""
    newest = long_ts.groupBy("country").agg(F.max(ts).alias("newest"))
    now = F.lit(f"{now_utc}").cast("timestamp_ntz")
    seconds = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col("newest").cast("timestamp"))
    minutes = round_half_up(seconds / 60.0)
    return newest.select(
        "country",
        F.col("newest").cast("string").alias("newest"),
        minutes.alias("age_minutes"),
        (minutes > stale_minutes).alias("stale"),
    )
