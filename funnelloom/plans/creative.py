"""One creative against its whole paid universe, per day on a full date spine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelloom.functions.dates import date_spine, start_of_day
from funnelloom.functions.ratios import pct, safe_ratio
from funnelloom.operators.events import DEAL, first_dates, stage_dates
from funnelloom.operators.joins import left_join_spread
from funnelloom.spec import STAGE_SPELLINGS, STAGES_NOT_ON_INMO

UNIVERSE, CREATIVE = "universe", "creative"
STAGES = tuple(STAGE_SPELLINGS)
COUNTS = (
    ("t", "cal", *STAGES)
    + ("t_mm", "cal_mm", *[f"{s}_mm" for s in STAGES])
    + ("t_inmo", "cal_inmo", *[f"{s}_inmo" for s in STAGES])
)


def paid_campaigns(dictionary: DataFrame, medium: str = "WEB Paid", platform: str = "Facebook") -> DataFrame:
    """Campaigns of the universe with the number of dictionary rows that name them.
    A plain join repeats a lead once per such row; the number keeps that effect
    without repeating it."""
    return (
        dictionary.where((F.col("channel_medium") == medium) & (F.col("platform") == platform))
        .where(F.col("campaign_original").isNotNull())
        .groupBy(F.col("campaign_original").alias("campaign"))
        .agg(F.count("*").alias("copies"))
    )


def creative_deals(deal_utm: DataFrame, creative: str) -> DataFrame:
    """Deals whose content equals the creative, ignoring case."""
    return (
        deal_utm.where((F.lower("utm_content") == creative) & F.col("deal_id").isNotNull())
        .select("deal_id")
        .distinct()
    )


def creative_ads(ads: DataFrame, creative: str) -> DataFrame:
    """Ads whose name begins like the creative; its underscores match any character."""
    return ads.where(F.lower("ad_name").like(f"{creative}%"))


def creative_cohort(
    leads: DataFrame, log: DataFrame, stage_log: DataFrame, dictionary: DataFrame, deal_utm: DataFrame,
    creative: str, first: dt.date, as_of: dt.date, country: str = "MX",
) -> DataFrame:
    """Leads of the universe with qualification and stage dates, and the creative flag."""
    base = leads.where(
        (F.col("country") == country)
        & (F.col("created_at") >= start_of_day(first))
        & (F.col("created_at") < start_of_day(as_of))
        & F.col("asset_id").isNotNull()
    ).select(*DEAL, "asset_id", F.to_date("created_at").alias("d"), "campaign")
    base = base.join(paid_campaigns(dictionary), "campaign").drop("campaign")
    mine = creative_deals(deal_utm, creative).select(
        F.lit(country).alias("country"), "deal_id", F.lit(1).alias("__mine")
    )
    one_country = log.where(F.col("country") == country)
    dates = first_dates(one_country)
    base = left_join_spread(base, mine, dates, on=DEAL, nullable="deal_id")
    stages = stage_dates(stage_log.where(F.col("country") == country))
    return base.join(stages, "asset_id", "left").withColumn(
        "is_creative", F.col("__mine").isNotNull()
    )


def _counts() -> list[Column]:
    mm, inmo = "mm_date IS NOT NULL", "inmo_date IS NOT NULL"

    def copies(test: str) -> str:
        return f"coalesce(sum(copies) FILTER (WHERE {test}), 0)"

    out = {"t": "count(DISTINCT asset_id)", "cal": copies(f"{mm} OR {inmo}")}
    out |= {s: copies(f"{s}_date IS NOT NULL") for s in STAGES}
    out |= {"t_mm": out["t"], "cal_mm": copies(mm)}
    out |= {f"{s}_mm": copies(f"{mm} AND {s}_date IS NOT NULL") for s in STAGES}
    out |= {"t_inmo": out["t"], "cal_inmo": copies(inmo)}
    for s in STAGES:
        late = s in STAGES_NOT_ON_INMO
        out[f"{s}_inmo"] = "CAST(0 AS BIGINT)" if late else copies(f"{inmo} AND {s}_date IS NOT NULL")
    return [F.expr(f"{sql} AS {name}") for name, sql in out.items()]


def universe_counts(cohort: DataFrame) -> DataFrame:
    """Counts per day for the universe and for the creative inside it, in one pass."""
    member = F.when(
        F.col("is_creative"), F.array(F.lit(UNIVERSE), F.lit(CREATIVE))
    ).otherwise(F.array(F.lit(UNIVERSE)))
    return cohort.withColumn("u", F.explode(member)).groupBy("d", "u").agg(*_counts())


def universe_spend(ads: DataFrame, dictionary: DataFrame, creative: str, first: dt.date, as_of: dt.date) -> DataFrame:
    """Spend per day of the universe's campaigns and, separately, of the creative's ads.
    A tagged union takes the place of two conditional joins."""
    rows = ads.where(
        (F.col("date_start") >= start_of_day(first)) & (F.col("date_start") < start_of_day(as_of))
    )
    day = F.to_date("date_start").alias("d")
    per_campaign = rows.groupBy(day, F.col("campaign_name").alias("campaign")).agg(
        F.sum("spend").alias("spend")
    )
    whole = (
        per_campaign.join(paid_campaigns(dictionary), "campaign")
        .groupBy("d")
        .agg(F.sum(F.col("spend") * F.col("copies")).alias("spend"))
        .withColumn("u", F.lit(UNIVERSE))
    )
    mine = creative_ads(rows, creative).groupBy(day).agg(F.sum("spend").alias("spend"))
    return whole.unionByName(mine.withColumn("u", F.lit(CREATIVE)))


def cross_spine(spark, first: dt.date, as_of: dt.date) -> DataFrame:
    """Every day of the experiment once per universe."""
    both = F.explode(F.array(F.lit(UNIVERSE), F.lit(CREATIVE))).alias("u")
    return date_spine(spark, first, as_of - dt.timedelta(days=1)).select("d", both)


def creative_vs_universe(cohort: DataFrame, spend: DataFrame, spine: DataFrame) -> DataFrame:
    counts = universe_counts(cohort)
    out = spine.join(counts, ["d", "u"], "left").join(spend, ["d", "u"], "left")
    money = F.coalesce(F.round(F.col("spend"), 2).cast("double"), F.lit(0.0)).alias("spend")
    zero = F.lit(0).cast("long")
    return out.select("d", "u", money, *[F.coalesce(F.col(c), zero).alias(c) for c in COUNTS])


def universe_totals(daily: DataFrame) -> DataFrame:
    money = F.round(F.sum(F.col("spend").cast("decimal(28,2)")), 2).cast("double").alias("spend")
    return daily.groupBy("u").agg(money, *[F.sum(c).alias(c) for c in COUNTS])


def unit_costs(totals: DataFrame) -> DataFrame:
    """Cost per qualified, appointment, visit and closing, and each stage's share of the
    track's base. Late stages of the second track do not apply."""
    rows = []
    for track, suffix in (("all", ""), ("mm", "_mm"), ("inmo", "_inmo")):
        gone = F.lit(None).cast("double")
        spend = F.col("spend")
        late = track == "inmo"
        cost = {
            f"cost_{s}": gone if late and s != "cal" else safe_ratio(spend, F.col(f"{s}{suffix}"))
            for s in ("cal", "cit", "vis", "cie")
        }
        shares = {
            f"pct_{s}": gone
            if late and s in STAGES_NOT_ON_INMO
            else pct(F.col(f"{s}{suffix}"), F.col(f"t{suffix}"))
            for s in ("cal", *STAGES)
        }
        cells = {"track": F.lit(track)} | cost | shares
        rows.append(F.struct(*[c.alias(n) for n, c in cells.items()]))
    return totals.select("u", F.inline(F.array(*rows)))
