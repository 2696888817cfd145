"""Events per deal or asset: first, latest, stage dates, transitions.

All of them are single grouped passes with map-side combining, so a deal with a large
part of the log shrinks to one row per task before anything is shuffled. Buffers are
fixed-width (numbers, times, decimals), which keeps the aggregates hash-based; only
``first_change_per_asset`` and ``dedup_first`` take the minimum of a struct and sort.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelloom.functions.dates import start_of_day, unix_micros_sql
from funnelloom.operators.scans import scan_state_log
from funnelloom.spec import (
    COUNTRIES,
    QUALIFIED_INMO,
    QUALIFIED_MM,
    REQUALIFIED,
    STAGE_SPELLINGS,
    WAITING_INCOMPLETE,
    WAITING_REVIEW,
    CountrySpec,
)

DEAL = ("country", "deal_id")
ASSET = ("country", "asset_id")


def first_event(log: DataFrame, states: Sequence[int], track: str | None = None, out: str = "first_at") -> DataFrame:
    """Earliest time in a state set per deal."""
    return scan_state_log(log, states, track).groupBy(*DEAL).agg(F.min("ts").alias(out))


def first_event_date(log: DataFrame, states: Sequence[int], track: str | None = None, out: str = "first_date") -> DataFrame:
    return first_event(log, states, track, out).withColumn(out, F.to_date(out))


def first_event_in_window(
    log: DataFrame, states: Sequence[int], first: dt.date, last_exclusive: dt.date, track: str | None = None
) -> DataFrame:
    """The true first event, kept only where it lies in the window.

    Only the upper bound may move below the grouping: rows after it can never be
    a first event inside the window, earlier rows decide whether there is one.
    """
    early = log.where(F.col("ts") < start_of_day(last_exclusive))
    return first_event(early, states, track).where(F.col("first_at") >= start_of_day(first))


def first_windowed_event(log: DataFrame, states: Sequence[int], first: Column, track: str | None = None) -> DataFrame:
    """The earliest event among rows that already lie in the window."""
    return first_event(log.where(F.col("ts") >= first), states, track)


_HALF = 1 << 31
_FIELD = 10**10


def _order(log: DataFrame) -> str:
    """Time, position and state of a log row as one decimal of 38 digits.

    A decimal is a fixed-width buffer, so the aggregate stays hash-based. Microseconds
    have 18 digits (years 1 to 9999), position and state ten each, the whole range of an
    INT moved to start at 0; a wider value raises. A missing position comes before all
    others; a row without time or state says nothing and is passed over.
    """
    micros = unix_micros_sql("ts", log.schema["ts"].dataType)
    seq = f"(CAST(CAST(coalesce(seq, -{_HALF}) AS INT) AS BIGINT) + {_HALF})"
    state = f"(CAST(CAST(state_id AS INT) AS BIGINT) + {_HALF})"
    return (
        f"CAST({micros} AS DECIMAL(18,0)) * {_FIELD**2} + CAST({seq} AS DECIMAL(10,0)) * {_FIELD}"
        f" + CAST({state} AS DECIMAL(10,0))"
    )


def _last(log: DataFrame, out: str, where: str | None = None) -> Column:
    """The state of the last row by ``_order``, as an aggregate."""
    kept = f" FILTER (WHERE {where})" if where else ""
    return F.expr(f"CAST(CAST(pmod(max({_order(log)}){kept}, {_FIELD}) AS BIGINT) - {_HALF} AS INT) AS {out}")


def latest_state(log: DataFrame, track: str = "mm", out: str = "state_id") -> DataFrame:
    """State of each deal after its last log row (time, then position, then id)."""
    rows = log.where(f"deal_id IS NOT NULL AND track = '{track}'")
    return rows.groupBy(*DEAL).agg(_last(log, out))


def current_state(log: DataFrame, current: DataFrame | None, track: str = "mm", out: str = "state_id") -> DataFrame:
    """State of each deal from the table of current states (country, deal_id, state_id,
    inmo_state_id; one row per deal) where there is one, else from the log."""
    if current is None:
        return latest_state(log, track, out)
    column = F.col("state_id" if track == "mm" else "inmo_state_id")
    return current.where(F.col("deal_id").isNotNull()).select(*DEAL, column.cast("int").alias(out))


def first_dates(log: DataFrame) -> DataFrame:
    """First qualification date on each track. Only qualifying rows leave the scan."""
    mm = F.col("state_id").isin(*QUALIFIED_MM) & (F.col("track") == "mm")
    inmo = F.col("state_id").isin(*QUALIFIED_INMO) & (F.col("track") == "inmo")
    return (
        log.where(F.col("deal_id").isNotNull() & (mm | inmo))
        .groupBy(*DEAL)
        .agg(F.to_date(F.min(F.when(mm, F.col("ts")))).alias("mm_date"),
             F.to_date(F.min(F.when(inmo, F.col("ts")))).alias("inmo_date"))
    )


def deal_summary(log: DataFrame) -> DataFrame:
    """Everything the cohort boards need per deal from one pass over both tracks:
    first qualification on each track and current state on each track."""
    mm = ", ".join(str(s) for s in QUALIFIED_MM)
    inmo = ", ".join(str(s) for s in QUALIFIED_INMO)
    return (
        log.where("deal_id IS NOT NULL")
        .groupBy(*DEAL)
        .agg(
            F.expr(f"to_date(min(ts) FILTER (WHERE track = 'mm' AND state_id IN ({mm}))) AS mm_date"),
            F.expr(f"to_date(min(ts) FILTER (WHERE track = 'inmo' AND state_id IN ({inmo}))) AS inmo_date"),
            _last(log, "state_id", "track = 'mm'"),
            _last(log, "inmo_state_id", "track = 'inmo'"),
        )
    )


def stage_dates(stage_log: DataFrame, keys: Sequence[str] = ("asset_id",)) -> DataFrame:
    """First date per funnel stage, every spelling of a stage counted."""
    day = F.to_date("ts")
    names = [s for spellings in STAGE_SPELLINGS.values() for s in spellings]
    return (
        stage_log.where(F.col("asset_id").isNotNull() & F.col("stage").isin(*names))
        .groupBy(*keys)
        .agg(
            *[
                F.min(F.when(F.col("stage").isin(*spellings), day)).alias(f"{stage}_date")
                for stage, spellings in STAGE_SPELLINGS.items()
            ]
        )
    )


def first_assignment(stage_log: DataFrame, specs: Iterable[CountrySpec] = COUNTRIES) -> DataFrame:
    """First assignment date per asset inside the second track's teams."""
    keep = None
    for spec in specs:
        one = (
            (F.col("country") == spec.code)
            & (F.col("stage") == spec.first_assignment)
            & F.col("team").isin(*spec.inmo_teams)
        )
        keep = one if keep is None else keep | one
    return (
        stage_log.where(F.col("asset_id").isNotNull() & keep)
        .groupBy(*ASSET)
        .agg(F.min(F.to_date("ts")).alias("assigned_date"))
    )


def transition_summary(log: DataFrame) -> DataFrame:
    """Ever in a waiting state, first entry to it and last qualified entry."""
    inc = F.col("state_id").isin(*WAITING_INCOMPLETE)
    rev = F.col("state_id").isin(*WAITING_REVIEW)
    states = (*WAITING_REVIEW, *WAITING_INCOMPLETE, REQUALIFIED)
    return (
        scan_state_log(log, states, "mm")
        .groupBy(*DEAL)
        .agg(
            F.max(F.when(inc, 1).otherwise(0)).alias("ever_inc"),
            F.max(F.when(rev, 1).otherwise(0)).alias("ever_rev"),
            F.min(F.when(inc, F.col("ts"))).alias("first_inc"),
            F.min(F.when(rev, F.col("ts"))).alias("first_rev"),
            F.max(F.when(F.col("state_id") == REQUALIFIED, F.col("ts"))).alias("last_20"),
        )
    )


def deal_transitions(log: DataFrame) -> DataFrame:
    """``transition_summary`` and the current state from one pass over the first track.
    Deals that never waited are present with their state only."""
    inc = ", ".join(str(s) for s in WAITING_INCOMPLETE)
    rev = ", ".join(str(s) for s in WAITING_REVIEW)
    return (
        log.where("deal_id IS NOT NULL AND track = 'mm'")
        .groupBy(*DEAL)
        .agg(
            F.expr(f"max(IF(state_id IN ({inc}), 1, 0)) AS ever_inc"),
            F.expr(f"max(IF(state_id IN ({rev}), 1, 0)) AS ever_rev"),
            F.expr(f"min(ts) FILTER (WHERE state_id IN ({inc})) AS first_inc"),
            F.expr(f"min(ts) FILTER (WHERE state_id IN ({rev})) AS first_rev"),
            F.expr(f"max(ts) FILTER (WHERE state_id = {REQUALIFIED}) AS last_20"),
            _last(log, "state_id"),
        )
    )


def rescued_after(first_entry: Column, last_qualified: Column) -> Column:
    """Qualified strictly after the first entry to the waiting state."""
    return F.coalesce(last_qualified > first_entry, F.lit(False))


def first_change_per_asset(changes: DataFrame) -> DataFrame:
    """Earliest owner change per asset; position breaks ties."""
    best = F.min(F.struct("changed_at", "seq", "owner_id"))
    return (
        changes.where(F.col("asset_id").isNotNull())
        .groupBy("asset_id")
        .agg(best.alias("first"))
        .select("asset_id", "first.changed_at", "first.owner_id")
    )


def dedup_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by ``order`` and then by all other columns.

    A grouped minimum over a struct instead of a ranking window: partial minima
    leave each task, so a key that repeats without limit never gathers anywhere.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    return (
        df.groupBy(key)
        .agg(F.min(F.struct(*order, *rest)).alias("__first"))
        .select(key, *[F.col(f"__first.{c}").alias(c) for c in (*order, *rest)])
    )


def attribute_events_to_leads(events: DataFrame, leads: DataFrame, on: Sequence[str] = DEAL) -> DataFrame:
    """Events with the columns of their lead. NULL keys are dropped before the shuffle."""
    return events.join(leads.where(F.col(on[-1]).isNotNull()), list(on))
