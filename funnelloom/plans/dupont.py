"""Daily review: registrations, qualified and spend per channel, and its matrix."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelloom.functions.dates import lookback_start
from funnelloom.functions.ratios import delta_pct, is_new, safe_ratio, significance_flag
from funnelloom.functions.text import channel_group_rank
from funnelloom.operators.channels import attach_channel, merge_leads_spend, spend_by_channel
from funnelloom.operators.events import DEAL, first_event
from funnelloom.operators.joins import left_join_spread
from funnelloom.operators.scans import scan_leads, scan_spend
from funnelloom.spec import QUALIFIED_MM

WINDOWS = (7, 14, 28, 56)
# Indicators with the direction that is better.
INDICATORS = (
    ("spend", "none"),
    ("cpl", "down"),
    ("reg", "up"),
    ("cvr", "up"),
    ("cal", "up"),
    ("share_cal", "none"),
)


def leads_by_channel(leads: DataFrame, log: DataFrame, dictionary: DataFrame, as_of: dt.date, days: int = 180) -> DataFrame:
    """Registrations per day and channel, and how many of them ever qualified."""
    base = scan_leads(leads, as_of, first=lookback_start(as_of, days))
    base = base.select(*DEAL, "created", "source_name", "campaign")
    rows = left_join_spread(base, first_event(log, QUALIFIED_MM, "mm"), on=DEAL, nullable="deal_id")
    counts = rows.groupBy("country", F.col("created").alias("dia"), "source_name", "campaign").agg(
        F.count("*").alias("reg"), F.count("first_at").alias("cal")
    )
    return (
        attach_channel(counts, dictionary)
        .groupBy("country", "dia", "channel")
        .agg(F.sum("reg").alias("reg"), F.sum("cal").alias("cal"))
    )


def dupont_daily(
    leads: DataFrame, log: DataFrame, dictionary: DataFrame, spend: DataFrame, as_of: dt.date, days: int = 180
) -> DataFrame:
    paid = spend_by_channel(
        scan_spend(spend, lookback_start(as_of, days), as_of), dictionary, F.col("day"), "dia"
    )
    counts = leads_by_channel(leads, log, dictionary, as_of, days)
    return merge_leads_spend(counts, paid, ("country", "dia", "channel"))


def period_over_period(daily: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Sums per channel for the N days that end on the country's last day with data
    and for the N days before."""
    # A window keeps the daily table from being computed twice. Its rows are aggregates:
    # at most one per day of the look-back and channel.
    last = F.max("dia").over(Window.partitionBy("country"))
    aged = daily.withColumn("age", F.datediff(last, "dia"))
    sizes = F.explode(F.array(*[F.lit(n) for n in windows])).alias("n")
    rows = aged.select("*", sizes).where(F.col("age") < 2 * F.col("n"))
    now = F.col("age") < F.col("n")

    def pair(c: str) -> list[Column]:
        empty = F.lit(None).cast("long") if c == "spend" else F.lit(0).cast("long")
        both = []
        for suffix, test in (("now", now), ("prev", ~now)):
            both.append(F.coalesce(F.sum(F.when(test, F.col(c))), empty).alias(f"{c}_{suffix}"))
        return both

    return rows.groupBy("country", "n", "channel").agg(*pair("reg"), *pair("cal"), *pair("spend"))


def two_level_totals(windows: DataFrame) -> DataFrame:
    """Channel rows with a grand total and a total over channels with any spend."""
    sums = [c for c in windows.columns if c.endswith(("_now", "_prev"))]
    paid = F.col("spend_now").isNotNull() | F.col("spend_prev").isNotNull()
    levels = F.explode(
        F.when(paid, F.array(F.lit("TOTAL"), F.lit("TOTAL Performance"))).otherwise(F.array(F.lit("TOTAL")))
    )
    totals = (
        windows.withColumn("level", levels)
        .groupBy("country", "n", "level")
        .agg(*[F.sum(c).alias(c) for c in sums])
        .withColumn("channel", F.lit(None).cast("string"))
    )
    return windows.withColumn("level", F.lit("channel")).unionByName(totals)


def dupont_matrix(daily: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Six indicators per channel and total: both windows, change and its reading."""
    rows = two_level_totals(period_over_period(daily, windows))
    over = Window.partitionBy("country", "n")
    for s in ("now", "prev"):
        total = F.max(F.when(F.col("level") == "TOTAL", F.col(f"cal_{s}"))).over(over)
        rows = rows.withColumn(f"__total_{s}", total)

    def values(s: str) -> list[Column]:
        reg, cal, spend = F.col(f"reg_{s}"), F.col(f"cal_{s}"), F.col(f"spend_{s}")
        return [
            spend.cast("double"),
            safe_ratio(spend, reg),
            reg.cast("double"),
            safe_ratio(cal, reg),
            cal.cast("double"),
            safe_ratio(cal, F.col(f"__total_{s}")),
        ]

    cells = [
        F.struct(
            F.lit(key).alias("indicator"),
            F.lit(way).alias("direction"),
            now.alias("now"),
            prev.alias("prev"),
        )
        for (key, way), now, prev in zip(INDICATORS, values("now"), values("prev"))
    ]
    long = rows.select("country", "n", "level", "channel", F.inline(F.array(*cells)))
    delta = long.withColumn("__delta", delta_pct(F.col("now"), F.col("prev")))
    return delta.select(
        "country",
        "n",
        "level",
        "channel",
        "indicator",
        "now",
        "prev",
        F.when(F.col("__delta") != F.lit(float("inf")), F.col("__delta")).alias("delta"),
        is_new(F.col("now"), F.col("prev")).alias("is_new"),
        significance_flag(F.col("__delta"), F.col("direction")).alias("flag"),
    )


def rank_within_group(windows: DataFrame, metric: str = "reg_now") -> DataFrame:
    """Row order of the matrix: channel group, then the metric, NULLs last in a group."""
    group = channel_group_rank(F.col("channel"))
    order = Window.partitionBy("country", "n").orderBy(
        "grp", F.desc_nulls_last(metric), F.asc_nulls_last("channel")
    )
    return windows.withColumn("grp", group).withColumn("position", F.row_number().over(order))


def share_of_total(windows: DataFrame) -> DataFrame:
    total = F.sum("cal_now").over(Window.partitionBy("country", "n"))
    return windows.select(
        "country", "n", "channel", safe_ratio(F.col("cal_now"), total).alias("share_cal")
    )
