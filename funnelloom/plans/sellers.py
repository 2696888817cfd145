"""Cohort boards at six grains: funnel, anti-funnel, missing track, waiting states."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelloom.functions.dates import flag_open_period
from funnelloom.functions.ratios import pct
from funnelloom.functions.text import state_name_fallback
from funnelloom.operators.events import (
    ASSET,
    DEAL,
    current_state,
    deal_summary,
    deal_transitions,
    first_assignment,
    first_dates,
    transition_summary,
)
from funnelloom.operators.joins import left_join_spread
from funnelloom.operators.rollup import cohort_by_grain, count_by_grain
from funnelloom.operators.scans import country_label, scan_leads
from funnelloom.spec import (
    LATE_DISCARD,
    QUALIFIED_MM,
    STATE_DUPLICATE,
    STATE_INCOMPLETE,
    WAITING_INCOMPLETE,
    WAITING_REVIEW,
)

NO_INMO_RECORD = "(sin registro Inmo)"


def enrich_first_events(
    leads: DataFrame, log: DataFrame, stage_log: DataFrame, as_of: dt.date, current: DataFrame | None = None
) -> DataFrame:
    """Leads with first qualification per track, current state and first assignment.

    With a table of current states only qualifying rows of the log are read; without
    one, one pass over the whole log serves the four deal-level columns.
    """
    with_deal = with_deal_facts(leads, log, as_of, current)
    return left_join_spread(with_deal, first_assignment(stage_log), on=ASSET, nullable="asset_id")


def with_deal_facts(leads: DataFrame, log: DataFrame, as_of: dt.date, current: DataFrame | None = None) -> DataFrame:
    """Leads with the columns that hang on their deal: first qualifications, current state."""
    base = scan_leads(leads, as_of).select(*DEAL, "asset_id", "source_id", "source_name", "created")
    if current is None:
        facts = [deal_summary(log)]
    else:
        states = current.where(F.col("deal_id").isNotNull()).select(*DEAL, "state_id", "inmo_state_id")
        facts = [first_dates(log), states]
    return left_join_spread(base, *facts, on=DEAL, nullable="deal_id")


SELLERS_METRICS = {
    "cal_mm": "mm_date IS NOT NULL",
    "cal_inmo": "inmo_date IS NOT NULL",
    "asg_inmo": "assigned_date IS NOT NULL",
    "cal_mm_no_inmo": "mm_date IS NOT NULL AND inmo_date IS NULL",
    "cal_mm_dup": f"mm_date IS NOT NULL AND state_id = {STATE_DUPLICATE}",
    "cal_mm_desc": f"mm_date IS NOT NULL AND state_id IN {LATE_DISCARD}",
    "incomp": f"state_id = {STATE_INCOMPLETE}",
    "dup": f"state_id = {STATE_DUPLICATE}",
}

ASSET_METRICS = {"asg_inmo": SELLERS_METRICS["asg_inmo"]}


def sellers_funnel(
    leads: DataFrame, log: DataFrame, stage_log: DataFrame, as_of: dt.date, current: DataFrame | None = None
) -> DataFrame:
    own = {m: test for m, test in SELLERS_METRICS.items() if m not in ASSET_METRICS}
    out = cohort_by_grain(
        with_deal_facts(leads, log, as_of, current), own, asset_facts=first_assignment(stage_log), asset_metrics=ASSET_METRICS
    )
    return out.select(
        "g",
        country_label(F.col("country")).alias("c"),
        F.col("source_id").alias("f"),
        F.col("source_name").alias("fn"),
        "p",
        "tr",
        "t",
        *SELLERS_METRICS,
    )


def antifunnel(
    leads: DataFrame, log: DataFrame, catalogue: DataFrame, as_of: dt.date, current: DataFrame | None = None
) -> DataFrame:
    """Leads that are not qualified now, by current state; no state means no row."""
    states = current_state(log, current).where(~F.col("state_id").isin(*QUALIFIED_MM))
    base = scan_leads(leads, as_of).where(F.col("deal_id").isNotNull()).select(*DEAL, "source_id", "created")
    rows = base.join(states, list(DEAL))
    out = count_by_grain(rows, ("country", "source_id", "state_id"))
    named = out.join(catalogue.select("state_id", "name"), "state_id", "left")
    state_id, state_name = state_name_fallback(F.col("name"), F.col("state_id"))
    return named.select(
        "g",
        country_label(F.col("country")).alias("c"),
        F.col("source_id").alias("f"),
        "p",
        state_id.alias("state_id"),
        state_name.alias("state_name"),
        "n",
    )


def missing_second_track(
    leads: DataFrame, log: DataFrame, as_of: dt.date, current: DataFrame | None = None
) -> DataFrame:
    """Leads that qualified on the first track and never on the second, with their
    current state there. The one-pass summary replaces an inner and an anti join."""
    summary = deal_summary(log) if current is None else first_dates(log)
    summary = summary.where(F.col("mm_date").isNotNull() & F.col("inmo_date").isNull())
    if current is not None:
        summary = summary.join(current_state(log, current, "inmo", "inmo_state_id"), list(DEAL), "left")
    base = scan_leads(leads, as_of).where(F.col("deal_id").isNotNull()).select(*DEAL, "source_id", "created")
    return base.join(summary.select(*DEAL, "inmo_state_id"), list(DEAL))


def mm_without_inmo(
    leads: DataFrame, log: DataFrame, catalogue: DataFrame, as_of: dt.date, current: DataFrame | None = None
) -> DataFrame:
    rows = missing_second_track(leads, log, as_of, current)
    out = count_by_grain(rows, ("country", "source_id", "inmo_state_id"))
    named = out.join(
        catalogue.select(F.col("state_id").alias("inmo_state_id"), "name"), "inmo_state_id", "left"
    )
    state_id, state_name = state_name_fallback(F.col("name"), F.col("inmo_state_id"), NO_INMO_RECORD)
    return named.select(
        "g",
        country_label(F.col("country")).alias("c"),
        F.col("source_id").alias("f"),
        "p",
        state_id.alias("state_id"),
        state_name.alias("state_name"),
        "n",
    )


def _waiting_metrics(prefix: str, states: tuple[int, ...]) -> dict[str, str]:
    """A NULL current state counts as having left; a rescue is a qualification
    strictly after the first entry."""
    passed = f"ever_{prefix} = 1"
    inside = ", ".join(str(s) for s in states)
    return {
        f"{prefix}_pass": passed,
        f"{prefix}_left": f"{passed} AND (state_id IS NULL OR state_id NOT IN ({inside}))",
        f"{prefix}_to_20": f"{passed} AND last_20 > first_{prefix}",
    }


TRANSITION_METRICS = _waiting_metrics("inc", WAITING_INCOMPLETE) | _waiting_metrics("rev", WAITING_REVIEW)


def transition_multi_grain(
    leads: DataFrame, log: DataFrame, as_of: dt.date, current: DataFrame | None = None
) -> DataFrame:
    base = scan_leads(leads, as_of).select(*DEAL, "asset_id", "source_id", "source_name", "created")
    if current is None:
        facts = [deal_transitions(log)]
    else:
        facts = [transition_summary(log), current_state(log, current)]
    metrics = TRANSITION_METRICS
    out = cohort_by_grain(left_join_spread(base, *facts, on=DEAL, nullable="deal_id"), metrics)
    return out.select(
        "g",
        "start",
        country_label(F.col("country")).alias("c"),
        F.col("source_id").alias("f"),
        F.col("source_name").alias("fn"),
        "p",
        "tr",
        "t",
        *metrics,
    )


def transitory_states(
    leads: DataFrame, log: DataFrame, as_of: dt.date, current: DataFrame | None = None
) -> DataFrame:
    return transition_multi_grain(leads, log, as_of, current).drop("start")


def scaled(rate: Column, window) -> Column:
    """Rate on a 0 to 1 scale over the shown periods; a zero range counts as 1."""
    low, high = F.min(rate).over(window), F.max(rate).over(window)
    span = F.when(high - low == 0, F.lit(1.0)).otherwise(high - low)
    return (rate - low) / span


def transitory_rates(board: DataFrame, as_of: dt.date, shown: int = 20) -> DataFrame:
    """Page rates per country and grain over all sources: passed, left, rescued, the
    rescue rate against both denominators, rates scaled over the shown periods, and
    the mark of the open period."""
    sums = ("tr", "inc_pass", "inc_left", "inc_to_20", "rev_pass", "rev_left", "rev_to_20")
    rows = board.groupBy("g", "c", "start", "p").agg(*[F.sum(s).alias(s) for s in sums])
    recent = F.row_number().over(Window.partitionBy("g", "c").orderBy(F.desc("start")))
    rows = rows.withColumn("__r", recent).where((F.col("g") == "Y") | (F.col("__r") <= shown))
    zero = F.lit(0.0)
    over = Window.partitionBy("g", "c")
    rates = {}
    for s in ("inc", "rev"):
        rates[f"{s}_pass_rate"] = F.coalesce(pct(F.col(f"{s}_pass"), F.col("tr")), zero)
        rates[f"{s}_left_rate"] = F.coalesce(pct(F.col(f"{s}_left"), F.col(f"{s}_pass")), zero)
        rates[f"{s}_rescue_of_pass"] = F.coalesce(pct(F.col(f"{s}_to_20"), F.col(f"{s}_pass")), zero)
        rates[f"{s}_rescue_of_left"] = F.coalesce(pct(F.col(f"{s}_to_20"), F.col(f"{s}_left")), zero)
    shown_rates = rows.select(
        "g",
        "c",
        "p",
        *[r.alias(n) for n, r in rates.items()],
        flag_open_period(as_of).alias("open_period"),
    )
    return shown_rates.select(
        "*",
        *[scaled(F.col(n), over).alias(f"{n}_scaled") for n in rates if not n.endswith("of_left")],
    )
