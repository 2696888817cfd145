"""Price quality of paid campaigns, and the weekly priority mix."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelloom.functions.dates import (
    bucket_label,
    bucket_of_day,
    bucket_start,
    iso_week_start,
    start_of_day,
)
from funnelloom.functions.ratios import pct, quality_band
from funnelloom.functions.text import state_name_fallback
from funnelloom.operators.compare import top_with_other
from funnelloom.operators.events import DEAL, current_state
from funnelloom.operators.joins import left_join_spread
from funnelloom.spec import ACTIVE_DAYS, TOP_STATES

OTHERS = "__OTROS__"
COUNTRY = "MX"
STEPS = {"D": "1 DAY", "W": "7 DAY", "M": "1 MONTH"}
PRIORITIES = ("A", "B", "C")
COUNTRY_NAMES = ("Colombia", "México")


def campaign_leads(
    leads: DataFrame, campaigns: Sequence[str], first: dt.date, country: str = COUNTRY
) -> DataFrame:
    """One country's leads of a fixed campaign list from a start day on; today is not excluded."""
    return leads.where(
        (F.col("country") == country) & (F.col("created_at") >= start_of_day(first)) & F.col("campaign").isin(*campaigns)
    )


def price_counts(deals: DataFrame) -> DataFrame:
    """Deals per asset with and without an asking price."""
    return deals.where(F.col("asset_id").isNotNull()).groupBy("asset_id").agg(
        F.count("ask_price").alias("__with"),
        F.expr("count_if(ask_price IS NULL) AS __without"),
    )


def price_presence(counts: DataFrame, deals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a left join of leads to deals by asset, split by price.

    ``counts`` holds ``n`` leads per (keys, asset). A lead meets every deal of its
    asset, so an asset adds leads times deals; a lead without deal is one row without
    price. Both sides are counted before the join, so no pair is ever formed.
    """
    joined = left_join_spread(counts, price_counts(deals), on=("asset_id",), nullable="asset_id")
    lone = F.when(F.col("__with").isNull(), F.lit(1)).otherwise(F.col("__without"))
    return joined.groupBy(*keys).agg(
        F.sum(F.col("n") * F.coalesce("__with", F.lit(0))).alias("with_price"),
        F.sum(F.col("n") * lone).alias("without_price"),
    )


def price_quality_daily(
    leads: DataFrame, deals: DataFrame, campaigns: Sequence[str], first: dt.date, country: str = COUNTRY
) -> DataFrame:
    rows = campaign_leads(leads, campaigns, first, country)
    counts = rows.groupBy(F.to_date("created_at").alias("d"), "campaign", "asset_id").agg(
        F.count("*").alias("n")
    )
    return price_presence(counts, deals, ["d", "campaign"])


def campaign_profile(daily: DataFrame, as_of: dt.date) -> DataFrame:
    """Per campaign: leads, first and last day, share without price and its band, and
    whether it is still active."""
    total = F.col("with_price") + F.col("without_price")
    out = daily.groupBy("campaign").agg(
        F.sum(total).alias("leads"),
        F.min("d").alias("first_day"),
        F.max("d").alias("last_day"),
        F.sum("without_price").alias("without_price"),
    )
    share = F.coalesce(pct(F.col("without_price"), F.col("leads")), F.lit(0.0))
    return out.select(
        "campaign",
        "leads",
        F.col("first_day").cast("string").alias("first_day"),
        F.col("last_day").cast("string").alias("last_day"),
        share.alias("pct_without"),
        quality_band(share).alias("band"),
        active(F.col("last_day"), as_of).alias("active"),
    )


def active(last_day, as_of: dt.date):
    return F.datediff(F.lit(as_of), last_day) <= ACTIVE_DAYS


def price_quality_grains(daily: DataFrame, grains: Sequence[str]) -> DataFrame:
    """All campaigns per grain and bucket on a spine without holes; a bucket without
    leads has counts of 0 and no share. Every grain comes from one pass over the days."""
    starts = F.array(*[F.struct(F.lit(g).alias("g"), bucket_start(F.col("d"), g).alias("bucket")) for g in grains])
    sums = (
        daily.select(F.inline(starts), "with_price", "without_price")
        .groupBy("g", "bucket")
        .agg(F.sum("with_price").alias("with_price"), F.sum("without_price").alias("without_price"))
    )
    # From the same sums, so that their shuffle is read twice rather than made twice.
    ends = sums.groupBy("g").agg(
        F.min("bucket").alias("first"), F.max("bucket").alias("last"),
        F.sum("with_price"), F.sum("without_price"),
    ).where(F.col("first").isNotNull())
    arms = " ".join(f"WHEN '{g}' THEN sequence(first, last, INTERVAL {STEPS[g]})" for g in grains)
    spine = ends.select("g", F.explode(F.expr(f"CASE g {arms} END")).alias("bucket"))
    out = spine.join(sums, ["g", "bucket"], "left")
    share = pct(F.col("without_price"), F.col("with_price") + F.col("without_price"))
    label = F.coalesce(*[F.when(F.col("g") == g, bucket_label(F.col("bucket"), g)) for g in grains])
    return out.select(
        "g",
        label.alias("bucket"),
        F.coalesce("with_price", F.lit(0)).alias("with_price"),
        F.coalesce("without_price", F.lit(0)).alias("without_price"),
        share.alias("pct_without"),
        quality_band(share).alias("band"),
    )


def price_quality(daily: DataFrame, grain: str) -> DataFrame:
    return price_quality_grains(daily, (grain,)).drop("g")


def price_quality_states(
    leads: DataFrame, deals: DataFrame, log: DataFrame, catalogue: DataFrame,
    campaigns: Sequence[str], first: dt.date, country: str = COUNTRY, current: DataFrame | None = None,
) -> DataFrame:
    """Leads without price per day, campaign and current state."""
    rows = campaign_leads(leads, campaigns, first, country).select(
        *DEAL, "asset_id", "campaign", F.to_date("created_at").alias("d")
    )
    with_state = left_join_spread(rows, current_state(log, current), on=DEAL, nullable="deal_id")
    counts = with_state.groupBy("d", "campaign", "state_id", "asset_id").agg(F.count("*").alias("n"))
    sums = price_presence(counts, deals, ["d", "campaign", "state_id"])
    named = sums.where(F.col("without_price") > 0).join(
        catalogue.select("state_id", "name"), "state_id", "left"
    )
    state_id, state_name = state_name_fallback(F.col("name"), F.col("state_id"))
    return named.select(
        "d", "campaign", state_id.alias("state_id"), state_name.alias("state_name"),
        F.col("without_price").alias("n"),
    )


def top_states_with_other(states: DataFrame, grain: str, n: int = TOP_STATES) -> DataFrame:
    """The n largest states and the rest per bucket."""
    rows = states.groupBy(
        bucket_start(F.col("d"), grain).alias("bucket"), "state_name"
    ).agg(F.sum("n").alias("n"))
    return top_with_other(rows, ["bucket"], "state_name", "n", n, OTHERS)


def priority_mix_weekly(deals: DataFrame, as_of: dt.date, weeks: int = 18) -> DataFrame:
    """Prioritised deals per complete week and country, split over three classes."""
    end = bucket_of_day(as_of, "W")
    first = bucket_of_day(as_of - dt.timedelta(weeks=weeks), "W")
    rows = deals.where(
        F.col("priority").isin(*PRIORITIES)
        & F.col("country").isin(*COUNTRY_NAMES)
        & (F.col("created") >= start_of_day(first))
        & (F.col("created") < start_of_day(end))
    )
    return rows.groupBy(iso_week_start(F.to_date("created")).alias("week"), "country").agg(
        F.count("*").alias("n"),
        *[F.expr(f"count_if(priority = '{p}') AS {p.lower()}") for p in PRIORITIES],
    )


def priority_grid(weekly: DataFrame) -> DataFrame:
    """Every week seen for every country, NULL where a country has no deals."""
    metrics = ("n", "a", "b", "c")
    cells = [
        F.struct(
            F.lit(c).alias("country"),
            *[F.when(F.col("country") == c, F.col(m)).alias(m) for m in metrics],
        )
        for c in COUNTRY_NAMES
    ]
    # Every row also opens its week for the other country.
    rows = weekly.select("week", F.inline(F.array(*cells)))
    return rows.groupBy("week", "country").agg(*[F.sum(m).alias(m) for m in metrics])


def priority_mix(weekly: DataFrame) -> DataFrame:
    n = F.col("n")
    return priority_grid(weekly).select(
        F.col("week").cast("string").alias("week"),
        "country",
        "n",
        "a",
        "b",
        "c",
        *[pct(F.col(p), n).alias(f"pct_{p}") for p in ("a", "b", "c")],
    )


def series_lists(weekly: DataFrame) -> DataFrame:
    """Week list and aligned metric lists per country."""
    cells = F.sort_array(F.collect_list(F.struct("week", "n", "a", "b", "c")))
    lists = priority_grid(weekly).groupBy("country").agg(cells.alias("x"))
    return lists.select(
        "country",
        F.transform(F.col("x.week"), lambda w: w.cast("string")).alias("weeks"),
        *[F.col(f"x.{m}").alias(m) for m in ("n", "a", "b", "c")],
    )


def source_catalogue(rows: DataFrame, order: Sequence[str], country: str = "country", source: str = "f") -> DataFrame:
    """Sources seen per country: known ones in their order, the rest in text order."""
    seen = rows.select(country, source).where(F.col(source).isNotNull()).distinct()
    rank = F.array_position(F.array(*[F.lit(s) for s in order]), F.col(source))
    rank = F.when(rank == 0, F.lit(len(order) + 1)).otherwise(rank)
    cells = F.sort_array(F.collect_list(F.struct(rank.alias("r"), F.col(source).alias("s"))))
    return seen.groupBy(country).agg(cells.alias("x")).select(country, F.col("x.s").alias("sources"))
