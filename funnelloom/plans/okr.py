"""Target tracking: year, quarters, months, weeks and cycles against targets and spend."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelloom.functions.dates import (
    cap_to_yesterday,
    prior_year_range,
    replace_year_clamped,
)
from funnelloom.functions.ratios import attainment_band, round_half_up, yoy_pct
from funnelloom.functions.text import case_map
from funnelloom.operators.channels import per_country
from funnelloom.operators.targets import range_sum_spend, weekly_targets
from funnelloom.spec import MONTH_NAMES, MONTH_SHORT

PERIODIC = ("quarterly", "monthly")
ROLLING = ("weekly", "cycles")


def period_rows(targets: DataFrame, as_of: dt.date) -> DataFrame:
    """Total rows that are shown, with their label and both spend ranges."""
    year = as_of.year
    total = targets.where(F.col("source") == "TOTAL")
    actual, mtd = F.coalesce("actual", F.lit(0)), F.coalesce("mtd", F.lit(0))
    section = F.col("section")
    shown = (
        (section == "annual")
        | (section.isin(*PERIODIC) & ((actual != 0) | (mtd != 0)))
        | (section.isin(*ROLLING) & (actual != 0))
    )
    yesterday = F.lit(as_of - dt.timedelta(days=1))
    number = F.array_position(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.col("period")).cast("int")
    quarter = F.substring("period", 2, 1).try_cast("int")
    first_month = (
        F.when(section == "quarterly", (quarter - 1) * 3 + 1)
        .when(section == "monthly", number)
        .otherwise(F.lit(1))
    )
    start = F.make_date(F.lit(year), first_month, F.lit(1))
    months = F.when(section == "quarterly", F.lit(2)).when(section == "monthly", F.lit(0)).otherwise(F.lit(11))
    end = F.least(F.last_day(F.add_months(start, months)), yesterday)
    now = (start, end)
    prev = (F.make_date(F.lit(year - 1), first_month, F.lit(1)), replace_year_clamped(end, year - 1))
    roll_now = cap_to_yesterday(*prior_year_range(F.col("from"), F.col("to"), year), as_of)
    roll_prev = prior_year_range(F.col("from"), F.col("to"), year - 1)
    rolling = section.isin(*ROLLING)
    short = dict(zip(MONTH_NAMES, MONTH_SHORT))
    dm = [F.coalesce(F.date_format(c, "dd/MM"), F.lit("?")) for c in ("from", "to")]
    label = (
        F.when(section == "annual", F.lit(str(year)))
        .when(section == "quarterly", F.col("period"))
        .when(section == "monthly", case_map(F.col("period"), short))
        .otherwise(F.concat(dm[0], F.lit(" - "), dm[1]))
    )

    def pick(i: int, rolled: tuple[Column, Column], fixed: tuple[Column, Column]) -> Column:
        return F.when(rolling, rolled[i]).otherwise(fixed[i])

    return total.where(shown).select(
        "country",
        "section",
        "row_no",
        label.alias("label"),
        F.col("meta").alias("target"),
        F.col("mtd").alias("to_date"),
        "actual",
        "prev",
        pick(0, roll_now, now).alias("now_from"),
        pick(1, roll_now, now).alias("now_to"),
        pick(0, roll_prev, prev).alias("prev_from"),
        pick(1, roll_prev, prev).alias("prev_to"),
    )


def okr_rows(targets: DataFrame, daily: DataFrame, as_of: dt.date) -> DataFrame:
    """Targets and results per period with spend of the period and of the year before."""
    rows = period_rows(targets, as_of)
    keys = ["section", "row_no", "label", "target", "to_date", "actual", "prev"]
    both = F.inline(
        F.array(
            F.struct(F.lit("now").alias("which"), F.col("now_from").alias("from"), F.col("now_to").alias("to")),
            F.struct(F.lit("prev").alias("which"), F.col("prev_from").alias("from"), F.col("prev_to").alias("to")),
        )
    )
    ranges = rows.select("country", *keys, both)
    sums = range_sum_spend(ranges, daily, [*keys, "which"])
    return sums.groupBy("country", *keys).agg(
        F.sum(F.when(F.col("which") == "now", F.col("spend"))).alias("spend"),
        F.sum(F.when(F.col("which") == "prev", F.col("spend"))).alias("spend_prev"),
    ).drop("row_no")


def okr_tracker(rows: DataFrame) -> DataFrame:
    """Page figures: attainment and its band, cost per assigned, changes on last year."""
    zero = F.lit(0)
    la, lm, lp = (F.coalesce(c, zero) for c in ("actual", "to_date", "prev"))

    def cost(spend: str, leads: Column) -> Column:
        return F.when(leads != 0, round_half_up(F.col(spend).cast("double") / leads.cast("double")))

    share = F.when(lm != 0, round_half_up(la.cast("double") / lm.cast("double") * F.lit(100.0)))
    ca, cp = cost("spend", la), cost("spend_prev", lp)
    return rows.select(
        "*",
        share.alias("attainment"),
        attainment_band(share).alias("band"),
        yoy_pct(la, lp).alias("leads_yoy"),
        yoy_pct(F.col("spend"), F.col("spend_prev")).alias("spend_yoy"),
        ca.alias("cpla"),
        cp.alias("cpla_prev"),
        yoy_pct(ca, cp).alias("cpla_yoy"),
    )


def weekly_with_targets(weekly: DataFrame, sheet: DataFrame) -> DataFrame:
    """Every shown source in every week with data, its target, and the target-only rows
    of the total and the group total."""
    metrics = ("reg", "cal", "asg")

    def cells(spec) -> Column:
        shown = [s for s in spec.sheet_blocks if s not in ("TOTAL", "Perfo")]
        out = []
        for s in (*shown, "TOTAL", "Perfo"):
            empty = "0L" if s in shown else "CAST(NULL AS BIGINT)"
            values = ", ".join(f"'{m}', IF(source = '{s}', {m}, {empty})" for m in metrics)
            money = f"'spend', CAST(IF(source = '{s}', spend, NULL) AS BIGINT)"
            out.append(f"named_struct('source', '{s}', {values}, {money})")
        return F.expr(f"array({', '.join(out)})")

    grid = weekly.select("country", "week_start", F.inline(per_country(cells)))
    rows = grid.groupBy("country", "week_start", "source").agg(
        *[F.sum(c).alias(c) for c in (*metrics, "spend")]
    )
    goals = weekly_targets(sheet).select(
        "country", F.col("week").cast("string").alias("week_start"), "source", "meta"
    )
    return rows.join(goals, ["country", "week_start", "source"], "left")
