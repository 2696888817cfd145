"""Weekly review: events counted in the week they happened, by source, channel, platform."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelloom.functions.dates import bucket_of_day, iso_week_start, lookback_start
from funnelloom.functions.text import case_map, label_source
from funnelloom.operators.channels import (
    attach_channel,
    attach_channel_tracked,
    per_country,
    spend_by_channel,
)
from funnelloom.operators.events import DEAL, attribute_events_to_leads, first_event_in_window
from funnelloom.operators.joins import assemble_metrics, fan_out_counts
from funnelloom.operators.scans import mart_country_code, official_source, scan_spend
from funnelloom.spec import LABELS_REVIEW, QUALIFIED_MM

COUNTS = ("reg", "cal", "asg")
SUMS = ("spend", "clicks", "impressions")


@dataclass(frozen=True)
class WeekWindow:
    """140 days back to the running ISO week, which is left out. All metrics but the
    qualifications start on a Monday."""

    first: dt.date
    first_cal: dt.date
    end: dt.date
    year_back: dt.date

    @classmethod
    def ending(cls, as_of: dt.date, days: int = 140) -> "WeekWindow":
        return cls(
            lookback_start(as_of, days, to_week=True),
            lookback_start(as_of, days),
            bucket_of_day(as_of, "W"),
            lookback_start(as_of, 365),
        )


def _in_days(day: Column, w: WeekWindow) -> Column:
    return (day >= F.lit(w.first)) & (day < F.lit(w.end))


def _created_in(w: WeekWindow) -> Column:
    first = F.lit(str(w.first)).cast("timestamp_ntz")
    end = F.lit(str(w.end)).cast("timestamp_ntz")
    return (F.col("created_at") >= first) & (F.col("created_at") < end)


def mart_in_window(mart: DataFrame, w: WeekWindow) -> DataFrame:
    """Assigned rows of official sources in the window, with country code and week."""
    rows = mart.withColumn("country", mart_country_code(F.col("country")))
    return rows.where(official_source() & _in_days(F.col("day"), w)).withColumn(
        "week", iso_week_start(F.col("day"))
    )


def spend_to_source(spend: DataFrame) -> DataFrame:
    """Source id by acquisition channel; rows without a source are dropped."""
    source = per_country(lambda s: case_map(F.col("acquisition_channel"), s.spend_sources))
    return spend.withColumn("source_id", source).where(F.col("source_id").isNotNull())


def week_text() -> Column:
    return F.col("week").cast("string").alias("week_start")


def weekly_by_source(leads: DataFrame, log: DataFrame, mart: DataFrame, spend: DataFrame, as_of: dt.date) -> DataFrame:
    w = WeekWindow.ending(as_of)
    keys = ["country", "week", "source_id"]
    base = leads.where(official_source())
    reg_week = iso_week_start(F.to_date("created_at")).alias("week")
    reg = base.where(_created_in(w)).groupBy("country", reg_week, "source_id")
    first = first_event_in_window(log, QUALIFIED_MM, w.first_cal, w.end, "mm")
    cal_rows = attribute_events_to_leads(first, base.select(*DEAL, "source_id"))
    cal_week = iso_week_start(F.to_date("first_at")).alias("week")
    cal = cal_rows.groupBy("country", cal_week, "source_id")
    asg = mart_in_window(mart, w).groupBy(*keys)
    paid = spend_to_source(scan_spend(spend, w.first, w.end))
    paid_week = iso_week_start(F.col("day")).alias("week")
    money = paid.groupBy("country", paid_week, "source_id").agg(
        F.round(F.sum("spend"), 0).cast("double").alias("spend")
    )
    out = assemble_metrics(
        [
            reg.agg(F.count("*").alias("reg")),
            cal.agg(F.count("*").alias("cal")),
            asg.agg(F.count("*").alias("asg")),
            money,
        ],
        keys,
        COUNTS,
        ("spend",),
    )
    source = label_source(F.col("source_id"), LABELS_REVIEW).alias("source")
    return out.select("country", week_text(), source, *COUNTS, "spend")


def _campaign_counts(leads: DataFrame, log: DataFrame, mart: DataFrame, w: WeekWindow) -> DataFrame:
    """Registrations, qualifications and assignments per week and raw campaign."""
    attrs = ["source_id", "source_name", "campaign"]
    recent = leads.where(
        official_source() & (F.col("created_at") >= F.lit(str(w.year_back)).cast("timestamp_ntz"))
    )
    reg_week = iso_week_start(F.to_date("created_at")).alias("week")
    reg = recent.where(_created_in(w)).groupBy("country", reg_week, *attrs).agg(F.count("*").alias("reg"))
    first = first_event_in_window(log, QUALIFIED_MM, w.first_cal, w.end, "mm")
    cal_week = iso_week_start(F.to_date("first_at")).alias("week")
    cal = (
        attribute_events_to_leads(first, recent.select(*DEAL, *attrs))
        .groupBy("country", cal_week, *attrs)
        .agg(F.count("*").alias("cal"))
    )
    asg = attribute_assignments(mart_in_window(mart, w), recent, attrs)
    parts = None
    for part in (reg, cal, asg):
        parts = part if parts is None else parts.unionByName(part, allowMissingColumns=True)
    return parts.groupBy("country", "week", *attrs).agg(*[F.sum(c).alias(c) for c in COUNTS])


def attribute_assignments(mart_rows: DataFrame, leads: DataFrame, attrs: list[str], out: str = "asg") -> DataFrame:
    """Assigned rows per week with the attributes of every lead of their asset. An
    asset with several leads counts several times, as in a plain join."""
    return fan_out_counts(
        mart_rows, leads, ["country", "asset_id"], ["country", "week"], attrs, out
    )


def _finish(counts: DataFrame, money: DataFrame, keys: list[str]) -> DataFrame:
    per_channel = counts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in COUNTS])
    out = assemble_metrics([per_channel, money], keys, COUNTS, SUMS)
    shown = [k for k in keys if k not in ("country", "week")]
    return out.select("country", week_text(), *shown, *COUNTS, *SUMS)


def weekly_by_channel(
    leads: DataFrame, log: DataFrame, mart: DataFrame, dictionary: DataFrame, spend: DataFrame, as_of: dt.date
) -> DataFrame:
    w = WeekWindow.ending(as_of)
    counts = attach_channel(_campaign_counts(leads, log, mart, w), dictionary)
    counts = counts.withColumn("source", label_source(F.col("source_id"), LABELS_REVIEW))
    money = spend_by_channel(
        scan_spend(spend, w.first, w.end),
        dictionary,
        iso_week_start(F.col("day")),
        "week",
        SUMS,
        with_source=True,
    )
    return _finish(counts, money, ["country", "week", "channel", "source"])


def weekly_by_platform(
    leads: DataFrame, log: DataFrame, mart: DataFrame, dictionary: DataFrame, spend: DataFrame, as_of: dt.date
) -> DataFrame:
    w = WeekWindow.ending(as_of)
    counts = attach_channel_tracked(_campaign_counts(leads, log, mart, w), dictionary)
    counts = counts.withColumn("source", label_source(F.col("source_id"), LABELS_REVIEW))
    money = spend_by_channel(
        scan_spend(spend, w.first, w.end),
        dictionary,
        iso_week_start(F.col("day")),
        "week",
        SUMS,
        with_source=True,
        with_platform=True,
    )
    return _finish(counts, money, ["country", "week", "platform", "channel", "source"])
