"""Assigned leads: mart, ever-assigned masks and the gap between them; filter explorer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelloom.functions.dates import iso_week_start, local_date, lookback_start, start_of_day
from funnelloom.functions.text import label_source
from funnelloom.operators.channels import per_country
from funnelloom.operators.events import first_change_per_asset, scan_state_log
from funnelloom.operators.joins import left_join_spread
from funnelloom.operators.masks import (
    attribute_first_failure,
    eligibility_flags_13,
    ever_owner,
    lead_flags,
    marginal_rows,
    marginal_sums,
    owner_flag,
    pack_bitmask,
    resolve_owner,
)
from funnelloom.operators.scans import mart_country_code
from funnelloom.spec import (
    ALL_ON,
    EXCLUDED_RATINGS,
    FLAGS_5,
    FLAGS_13,
    LABEL_EXPLORER_OTHER,
    LABELS_EXPLORER,
    QUALIFIED_MM,
)

DAYS = 540


def flagged_leads(leads: DataFrame, as_of: dt.date, days: int = DAYS) -> DataFrame:
    """Labelled leads of the window with the flags that need no join. The day of
    ``as_of`` stays in."""
    rows = leads.where(F.col("created_at") >= start_of_day(lookback_start(as_of, days)))
    label = per_country(lambda s: label_source(F.col("source_id"), s.labels_assigned))
    return rows.select(
        "country",
        F.to_date("created_at").alias("d"),
        label.alias("f"),
        "asset_id",
        "owner_id",
        ever_owner().alias("ever_owner"),
        *[c.alias(n) for n, c in lead_flags().items()],
    ).where(F.col("f").isNotNull())


def mart_keys(mart: DataFrame) -> DataFrame:
    return mart.select(
        mart_country_code(F.col("country")).alias("country"), "asset_id"
    ).where(F.col("country").isNotNull() & F.col("asset_id").isNotNull()).distinct()


def eligibility_counts(leads: DataFrame, owners: DataFrame, mart: DataFrame, as_of: dt.date) -> DataFrame:
    """Leads per day, source, flags, owner status and mart membership.

    Mart membership is joined at lead level, the owner only after counting: what is
    left then is one row per owner and flag combination of a day.
    """
    keys = mart_keys(mart).withColumn("__hit", F.lit(True))
    rows = left_join_spread(flagged_leads(leads, as_of), keys, on=("country", "asset_id"), nullable="asset_id")
    own = [f for f in FLAGS_5 if f != "pf_owner"]
    counts = rows.groupBy(
        "country", "d", "f", "owner_id", "ever_owner", *own, F.col("__hit").isNotNull().alias("in_mart")
    ).agg(F.count("*").alias("n"))
    named = resolve_owner(counts, owners)
    return named.withColumn("pf_owner", owner_flag(F.col("owner_email"))).drop("owner_email", "owner_id")


def assigned_explorer(leads: DataFrame, owners: DataFrame, mart: DataFrame, as_of: dt.date) -> DataFrame:
    """The three series from one pass: leads in the mart, ever-assigned leads per mask,
    and ever-assigned leads outside the mart per first failed rule."""
    counts = eligibility_counts(leads, owners, mart, as_of)
    flags = [F.col(f) for f in FLAGS_5]
    no_mask, no_bucket = F.lit(None).cast("long"), F.lit(None).cast("string")

    def row(series: str, m, bucket, test):
        cells = F.struct(F.lit(series).alias("series"), m.alias("m"), bucket.alias("bucket"))
        return F.when(test, F.array(cells)).otherwise(F.array().cast(
            "array<struct<series:string,m:bigint,bucket:string>>"
        ))

    series = F.concat(
        row("mart", no_mask, no_bucket, F.col("in_mart")),
        row("ever", pack_bitmask(flags), no_bucket, F.col("ever_owner")),
        row("gap", no_mask, attribute_first_failure(flags), F.col("ever_owner") & ~F.col("in_mart")),
    )
    return (
        counts.select("country", "d", "f", "n", F.inline(series))
        .groupBy("country", "d", "f", "m", "bucket", "series")
        .agg(F.sum("n").alias("n"))
    )


# --- thirteen-rule explorer ---------------------------------------------------------
def explorer_rows(
    changes: DataFrame, owners: DataFrame, deal_info: DataFrame, leads: DataFrame, log: DataFrame,
    as_of: dt.date, offset: int = -5, days: int = DAYS, country: str = "CO",
) -> DataFrame:
    """First assignments with each lead of one country and their asset, counted per day, source,
    qualification and the thirteen flags.

    Leads are counted per asset and attribute before the join, so an asset with very
    many leads becomes as many rows as it has attribute combinations. Owners are
    resolved on the counts, where a busy owner is a few rows rather than most of them.
    """
    first = first_change_per_asset(changes).withColumn("d", local_date(F.col("changed_at"), offset))
    first = first.where(F.col("d") >= F.lit(lookback_start(as_of, days))).drop("changed_at")
    deals = deal_info.select(
        "asset_id",
        F.lower(F.trim("state_text")).alias("deal_state"),
        F.col("digital_contact").isNotNull().alias("has_contact"),
    )
    rating = F.coalesce(F.lower(F.trim("rating")), F.lit(""))
    label = F.coalesce(label_source(F.col("source_id"), LABELS_EXPLORER), F.lit(LABEL_EXPLORER_OTHER))
    facts = (
        leads.where((F.col("country") == country) & F.col("asset_id").isNotNull())
        .groupBy(
            "asset_id",
            label.alias("f"),
            (~rating.isin(*EXCLUDED_RATINGS)).alias("rating_ok"),
            F.coalesce(F.col("priced") == 1, F.lit(False)).alias("price_ok"),
            F.col("created_at").isNotNull().alias("dated"),
        )
        .agg(F.count("*").alias("n"))
    )
    qualified = (
        scan_state_log(log.where(F.col("country") == country), QUALIFIED_MM, "mm")
        .select(F.col("deal_id").alias("asset_id"))
        .distinct()
        .withColumn("c", F.lit(1))
    )
    rows = (
        first.join(deals, "asset_id", "left")
        .join(facts, "asset_id", "left")
        .join(qualified, "asset_id", "left")
    )
    no = F.lit(False)
    counts = rows.groupBy(
        "d",
        F.coalesce("c", F.lit(0)).alias("c"),
        F.coalesce("f", F.lit(LABEL_EXPLORER_OTHER)).alias("f"),
        "owner_id",
        "deal_state",
        F.coalesce("has_contact", no).alias("has_contact"),
        # Without a lead its rating is missing, which passes.
        F.coalesce("rating_ok", F.lit(True)).alias("rating_ok"),
        F.coalesce("price_ok", no).alias("price_ok"),
        F.coalesce("dated", no).alias("dated"),
        F.col("n").isNotNull().alias("has_lead"),
    ).agg(F.sum(F.coalesce("n", F.lit(1))).alias("n"))
    flags = [flag.alias(name) for name, flag in eligibility_flags_13().items()]
    return resolve_owner(counts, owners).select("d", "c", "f", "n", *flags)


def explorer_masks(rows: DataFrame) -> DataFrame:
    """Counts per day, mask, qualification and source: what filters are applied to."""
    m = pack_bitmask([F.col(f) for f in FLAGS_13])
    return rows.groupBy("d", m.alias("m"), "c", "f").agg(F.sum("n").alias("n"))


def complete_weeks(masks: DataFrame, as_of: dt.date) -> DataFrame:
    weekly = masks.withColumn("week", iso_week_start(F.col("d")))
    return weekly.where(F.col("week") < iso_week_start(F.lit(as_of)))


def filter_effects(masks: DataFrame, as_of: dt.date, required: int = ALL_ON, latest: bool = False) -> DataFrame:
    """Marginal effect of every filter in every complete week, or in the latest one."""
    wide = marginal_sums(complete_weeks(masks, as_of), ["week"], required)
    if latest:
        wide = wide.orderBy(F.desc("week")).limit(1)
    return marginal_rows(wide, ["week"], required)
