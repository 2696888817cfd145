"""Web form funnel by traffic source, from page views to the resulting lead."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelloom.functions.dates import bucket_start, local_date_tz
from funnelloom.functions.text import case_map, classify_traffic
from funnelloom.operators.compare import period_summary, step_conversion
from funnelloom.operators.joins import left_join_spread
from funnelloom.spec import (
    FORM_ALL_STAGES,
    FORM_LAST_PATH,
    FORM_PATHS,
    FORM_PREFIX,
    FORM_SOURCES,
    FORM_SUB_SOURCE,
    FORM_UNTRACKED_SOURCE,
)

ZONE = "America/Bogota"
NO_DEAL = "completions_no_deal"
STAGE_BITS = {stage: 1 << i for i, stage in enumerate(dict.fromkeys(s for _, s in FORM_PATHS))}
LAST_STAGE = dict(FORM_PATHS)[FORM_LAST_PATH]
LEAD = "lead_hubspot"


def local_day(df: DataFrame, ts: str, zone: str) -> Column:
    return local_date_tz(ts, df.schema[ts].dataType, zone)


def _near(ts: str, first: dt.date, as_of: dt.date) -> Column:
    """Coarse bound on a raw time, a day or more wider than the local days at each end."""
    lowest = F.lit(str(first - dt.timedelta(days=1))).cast("timestamp_ntz")
    highest = F.lit(str(as_of + dt.timedelta(days=2))).cast("timestamp_ntz")
    return (F.col(ts) >= lowest) & (F.col(ts) < highest)


def scan_pageviews(pageviews: DataFrame, as_of: dt.date, days: int = 180, zone: str = ZONE) -> DataFrame:
    """Form page views of known visitors in the local-day window, today excluded.

    A coarse bound on the raw timestamp, one day wider at each end, reaches the scan;
    the exact local-day test follows.
    """
    first = as_of - dt.timedelta(days=days)
    rows = pageviews.where(
        _near("ts", first, as_of)
        & F.col("path").like(f"{FORM_PREFIX}%")
        & F.col("anonymous_id").isNotNull()
    )
    rows = rows.withColumn("d", local_day(rows, "ts", zone))
    return rows.where((F.col("d") >= F.lit(first)) & (F.col("d") < F.lit(as_of))).withColumn(
        "source", classify_traffic(F.col("url"), F.col("referrer"))
    )


def path_to_stage(path: Column) -> Column:
    """Stage of a form path; NULL for paths that are no stage."""
    return case_map(path, dict(FORM_PATHS))


def visitor_days(views: DataFrame) -> DataFrame:
    """One row per day, source and visitor; ``seen`` has a bit per stage reached.

    All that is counted later is counted on these rows, so the page views are grouped
    once and a stage's distinct visitors are a plain sum.
    """
    bits = case_map(F.col("path"), {path: STAGE_BITS[stage] for path, stage in FORM_PATHS})
    # A join on these rows would add the same test to one of their two uses only, and
    # the scan and grouping behind them could not be shared.
    known = views.where(F.col("d").isNotNull() & F.col("anonymous_id").isNotNull())
    return known.groupBy("d", "source", "anonymous_id").agg(F.bit_or(bits).alias("seen"))


def _reached(stage: str) -> Column:
    return F.coalesce(F.col("seen").bitwiseAND(F.lit(STAGE_BITS[stage])) != 0, F.lit(False))


def stages_daily(views: DataFrame) -> DataFrame:
    """Distinct visitors per day, source and stage."""
    sums = visitor_days(views).groupBy("d", "source").agg(
        *[F.sum(_reached(s).cast("long")).alias(s) for s in STAGE_BITS]
    )
    cells = [F.struct(F.lit(s).alias("stage"), F.col(s).alias("n")) for s in STAGE_BITS]
    return sums.select("d", "source", F.inline(F.array(*cells))).where("n > 0")


def _sessions(select_content: DataFrame, zone: str) -> DataFrame:
    return (
        select_content.where(F.col("anonymous_id").isNotNull())
        .select("anonymous_id", local_day(select_content, "ts", zone).alias("d_form"), "backbone_uuid")
        .distinct()
    )


def _resolve(sessions: DataFrame, bridge: DataFrame, deals: DataFrame, leads: DataFrame) -> DataFrame:
    """Sessions followed to their deal, its asset and the asset's lead days; every hop
    is a left join, so an unresolved session keeps a row."""
    hop = bridge.where(F.col("uuid").isNotNull()).select(F.col("uuid").alias("backbone_uuid"), "deal_uuid")
    chain = left_join_spread(sessions, hop, on=["backbone_uuid"], nullable="backbone_uuid")
    known = deals.where(F.col("deal_uuid").isNotNull()).select("deal_uuid", "asset_id")
    chain = left_join_spread(chain, known, on=["deal_uuid"], nullable="deal_uuid")
    days = leads.where(F.col("asset_id").isNotNull()).select(
        "asset_id", F.to_date("created_at").alias("d_lead")
    ).distinct()
    return left_join_spread(chain, days, on=["asset_id"], nullable="asset_id")


def chain_session_to_deal(
    views: DataFrame, select_content: DataFrame, bridge: DataFrame, deals: DataFrame, leads: DataFrame,
    zone: str = ZONE,
) -> DataFrame:
    """Completions followed through session and bridge to the deal and its lead day.

    Sessions and lead days are reduced to distinct rows first: only distinct visitors
    and assets are counted later, and a repeated row would only multiply.
    """
    done = (
        views.where(F.col("path") == FORM_LAST_PATH)
        .select(F.col("d").alias("d_form"), "source", "anonymous_id")
        .distinct()
    )
    # One visitor may own much of a day's sessions. As an inner join that side can be
    # split at run time; a left join could split only the other one. Completions
    # without any session follow by an anti join on distinct keys.
    sessions, on = _sessions(select_content, zone), ["anonymous_id", "d_form"]
    lone = done.join(sessions.select(*on).distinct(), on, "left_anti")
    chain = done.join(sessions, on).unionByName(
        lone.withColumn("backbone_uuid", F.lit(None).cast("string"))
    )
    return _resolve(chain, bridge, deals, leads)


def form_counts(
    days: DataFrame, select_content: DataFrame, bridge: DataFrame, deals: DataFrame, leads: DataFrame,
    zone: str = ZONE,
) -> DataFrame:
    """Long rows (d, source, stage, n) of the tracked sources from one pass.

    Visitor days and the resolved sessions of completions meet in one grouping: by
    visitor they tell the stages reached and whether any session (or the lack of one)
    leaves the completion unmatched; by asset they tell the matched leads. The chain is
    run once, and completions without a session need no anti join: they are the
    visitor days that no session row has joined. One visitor can be both matched by one
    session and unmatched by another.
    """
    done = days.where(_reached(LAST_STAGE)).select(F.col("d").alias("d_form"), "source", "anonymous_id")
    chain = _resolve(done.join(_sessions(select_content, zone), ["anonymous_id", "d_form"]), bridge, deals, leads)
    hit = F.coalesce(F.col("asset_id").isNotNull() & (F.col("d_lead") == F.col("d_form")), F.lit(False))
    followed = F.array(
        F.struct(F.lit(LEAD).alias("kind"), F.when(hit, F.col("asset_id").cast("string")).alias("id"), F.lit(False).alias("lost")),
        F.struct(F.lit("visitor").alias("kind"), F.col("anonymous_id").cast("string").alias("id"), (~hit).alias("lost")),
    )
    rows = (
        chain.select(F.col("d_form").alias("d"), "source", F.inline(followed))
        .where("id IS NOT NULL")
        .withColumns({"seen": F.lit(None).cast("int"), "session": F.lit(True)})
    )
    own = days.select(
        "d", "source", F.lit("visitor").alias("kind"), F.col("anonymous_id").cast("string").alias("id"),
        F.lit(False).alias("lost"), "seen", F.lit(False).alias("session"),
    )
    met = own.unionByName(rows).groupBy("d", "source", "kind", "id").agg(
        F.bit_or("seen").alias("seen"), F.bool_or("lost").alias("lost"), F.bool_or("session").alias("session")
    )
    visitor = F.col("kind") == "visitor"
    lost = visitor & (F.col("lost") | (_reached(LAST_STAGE) & ~F.col("session")))
    sums = {s: visitor & _reached(s) for s in STAGE_BITS} | {LEAD: ~visitor, NO_DEAL: lost}
    daily = met.groupBy("d", "source").agg(*[F.sum(c.cast("long")).alias(s) for s, c in sums.items()])
    cells = [F.struct(F.lit(s).alias("stage"), F.col(s).alias("n")) for s in sums]
    return daily.select("d", "source", F.inline(F.array(*cells))).where("n > 0")


def referral_leads(crm_deals: DataFrame, as_of: dt.date, days: int = 180, zone: str = ZONE) -> DataFrame:
    """Leads of the form without page tracking, counted at the CRM by local day."""
    first = as_of - dt.timedelta(days=days)
    day = local_day(crm_deals, "created", zone)
    rows = crm_deals.where(
        (F.col("sub_source") == FORM_SUB_SOURCE) & _near("created", first, as_of)
        & (day >= F.lit(first)) & (day < F.lit(as_of))
    )
    return rows.groupBy(day.alias("d")).agg(F.count("*").alias("n")).select(
        "d", F.lit(FORM_UNTRACKED_SOURCE).alias("source"), F.lit(LEAD).alias("stage"), "n"
    )


def web_form_funnel(
    pageviews: DataFrame, select_content: DataFrame, bridge: DataFrame, deals: DataFrame, leads: DataFrame,
    crm_deals: DataFrame, as_of: dt.date,
) -> DataFrame:
    """Long rows (day, source, stage, n)."""
    views = scan_pageviews(pageviews, as_of)
    # A session belongs to the local day of a page view, so it lies in the same window.
    select_content = select_content.where(_near("ts", as_of - dt.timedelta(days=180), as_of))
    counted = form_counts(visitor_days(views), select_content, bridge, deals, leads)
    return counted.select("d", "source", "stage", "n").unionByName(
        referral_leads(crm_deals, as_of).select("d", "source", "stage", "n")
    )


def pivot_stages(long: DataFrame) -> DataFrame:
    """One column per stage for every day seen and every source. A tracked source has 0
    where it had none; the untracked one has NULL for all stages but the last."""
    cells = [
        F.struct(F.lit(s).alias("source"), F.when(F.col("source") == s, F.col("n")).alias("n"))
        for s in FORM_SOURCES
    ]
    # Every row also opens its day for the other sources, so the days need no second pass.
    grid = long.select("d", "stage", F.inline(F.array(*cells)))
    filled = grid.groupBy("d", "source").pivot("stage", [*FORM_ALL_STAGES, NO_DEAL]).agg(F.sum("n"))
    tracked = F.col("source") != FORM_UNTRACKED_SOURCE

    def cell(stage: str) -> Column:
        value = F.coalesce(F.col(stage), F.lit(0))
        return (value if stage == LEAD else F.when(tracked, value)).alias(stage)

    return filled.select("d", "source", *[cell(s) for s in (*FORM_ALL_STAGES, NO_DEAL)])


def stage_totals(wide: DataFrame, first: dt.date) -> DataFrame:
    """Stage totals of the window per source, NULL where nothing is tracked."""
    sums = wide.where(F.col("d") >= F.lit(first)).groupBy("source").agg(
        *[F.sum(s).alias(s) for s in (*FORM_ALL_STAGES, NO_DEAL)]
    )
    cells = [
        F.struct(F.lit(i).alias("stage_no"), F.lit(s).alias("stage"), F.col(s).alias("n"))
        for i, s in enumerate(FORM_ALL_STAGES)
    ]
    return sums.select("source", F.col(NO_DEAL).alias(NO_DEAL), F.inline(F.array(*cells)))


def web_form_conversion(wide: DataFrame, first: dt.date) -> DataFrame:
    return step_conversion(stage_totals(wide, first), ["source"], "stage_no", "n")


def web_form_trend(wide: DataFrame, first: dt.date, grain: str) -> DataFrame:
    """Leads per bucket and source."""
    rows = wide.where(F.col("d") >= F.lit(first))
    return rows.groupBy("source", bucket_start(F.col("d"), grain).alias("bucket")).agg(
        F.coalesce(F.sum(LEAD), F.lit(0)).alias("n")
    )


def web_form_summary(wide: DataFrame, first: dt.date, grain: str = "W") -> DataFrame:
    return period_summary(web_form_trend(wide, first, grain), ["source"], "bucket", "n")
