"""Targets from the spreadsheet and their comparison with results and spend."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelloom.functions.text import parse_dmy_date, parse_latam_number
from funnelloom.operators.channels import per_country
from funnelloom.operators.scans import scan_spend
from funnelloom.spec import MONTH_NAMES, SHEET_BLOCK, SHEET_FIRST_OFFSET, SHEET_SECTIONS

VALUES = ("meta", "mtd", "actual", "prev")


def section_of(title: Column) -> Column:
    """Section named by a title cell; NULL for any other cell."""
    out = None
    for word, section in SHEET_SECTIONS:
        test = title.contains(word)
        out = F.when(test, F.lit(section)) if out is None else out.when(test, F.lit(section))
    return out


def sheet_rows(sheet: DataFrame) -> DataFrame:
    """Data rows with the section they stand in, up to the first daily title."""
    # Partitioned by country: one hand-kept spreadsheet each.
    whole = Window.partitionBy("country")
    first = F.trim(F.element_at("cells", 1))
    rows = sheet.where(F.size("cells") >= 7).withColumn("__title", section_of(first))
    carried = F.last("__title", ignorenulls=True).over(whole.orderBy("row_no"))
    stop = F.min(F.when(F.col("__title") == "stop", F.col("row_no"))).over(whole)
    rows = rows.withColumns({"section": carried, "__stop": stop})
    return rows.where(
        F.col("__title").isNull()
        & F.col("section").isNotNull()
        & (F.col("__stop").isNull() | (F.col("row_no") < F.col("__stop")))
        & first.rlike("^[0-9]+$")
    ).select(
        "country",
        "row_no",
        "section",
        F.trim(F.element_at("cells", 2)).alias("period"),
        parse_dmy_date(F.element_at("cells", 3)).alias("from"),
        parse_dmy_date(F.element_at("cells", 5)).alias("to"),
        "cells",
    )


def unpivot_blocks(rows: DataFrame, strip_commas: bool = False) -> DataFrame:
    """One row per source block that lies inside the sheet row."""

    def blocks(spec) -> Column:
        cells = []
        for i, name in enumerate(spec.sheet_blocks):
            at = SHEET_FIRST_OFFSET + SHEET_BLOCK * i
            values = ", ".join(
                f"'{v}', try_element_at(nums, {at + k + 1})" for k, v in enumerate(VALUES)
            )
            inside = f"size(nums) > {at + len(VALUES) - 1}"
            cells.append(f"IF({inside}, named_struct('source', '{name}', {values}), NULL)")
        return F.expr(f"array_compact(array({', '.join(cells)}))")

    kept = ("country", "row_no", "section", "period", "from", "to")
    numbers = F.transform("cells", lambda c: parse_latam_number(c, strip_commas)).alias("nums")
    return rows.select(*kept, numbers).select(*kept, F.inline(per_country(blocks)))


def targets_from_sheet(sheet: DataFrame) -> DataFrame:
    """Long target rows of all sections.

    A repeated year, quarter or month counts with its last row. Weeks and cycles need a
    total that has an actual or to-date value.
    """
    rows = sheet_rows(sheet)
    named = (
        (F.col("section") == "annual")
        | ((F.col("section") == "quarterly") & F.col("period").startswith("Q"))
        | ((F.col("section") == "monthly") & F.col("period").isin(*MONTH_NAMES))
        | F.col("section").isin("weekly", "cycles")
    )
    single = F.when(F.col("section") == "annual", F.lit("")).when(
        F.col("section").isin("quarterly", "monthly"), F.col("period")
    ).otherwise(F.col("row_no").cast("string"))
    latest = F.row_number().over(
        Window.partitionBy("country", "section", single).orderBy(F.desc("row_no"))
    )
    rows = rows.where(named).withColumn("__latest", latest).where(F.col("__latest") == 1)
    long = unpivot_blocks(rows)
    live = F.max(
        (F.col("source") == "TOTAL")
        & ((F.coalesce("actual", F.lit(0)) != 0) | (F.coalesce("mtd", F.lit(0)) != 0))
    ).over(Window.partitionBy("country", "row_no"))
    return (
        long.withColumn("__live", live)
        .where(F.col("__live") | ~F.col("section").isin("weekly", "cycles"))
        .drop("__live")
    )


def weekly_targets(sheet: DataFrame) -> DataFrame:
    """Targets by week and source for weeks that begin on a Monday. Everything between
    the weekly title and the daily one is read; the last row of a week counts."""
    rows = sheet_rows(sheet).where(F.col("section").isin("weekly", "cycles"))
    rows = keep_monday_weeks(rows, "from")
    latest = F.row_number().over(Window.partitionBy("country", "from").orderBy(F.desc("row_no")))
    rows = rows.withColumn("__latest", latest).where(F.col("__latest") == 1)
    return unpivot_blocks(rows, strip_commas=True).select(
        "country", F.col("from").alias("week"), "source", "meta"
    )


def keep_monday_weeks(rows: DataFrame, day: str) -> DataFrame:
    return rows.where(F.weekday(day) == 0)


def subtract_source_total(long: DataFrame, country: str, exclude: str) -> DataFrame:
    """Take one source out of TOTAL in one country and drop its rows. A NULL total
    stays NULL, a NULL part counts as 0."""
    w = Window.partitionBy("country", "row_no")
    here = F.col("country") == country
    out = long
    for v in VALUES:
        part = F.max(F.when(F.col("source") == exclude, F.col(v))).over(w)
        smaller = F.col(v) - F.coalesce(part, F.lit(0))
        out = out.withColumn(f"__{v}", F.when(here & (F.col("source") == "TOTAL"), smaller).otherwise(F.col(v)))
    kept = [c for c in long.columns if c not in VALUES]
    return out.where(~(here & (F.col("source") == exclude))).select(
        *kept, *[F.col(f"__{v}").alias(v) for v in VALUES]
    )


def spend_to_date(daily: DataFrame) -> DataFrame:
    """``country, day, upto``: spend up to each calendar day between the first and the last
    one with spend, so that any day in between is found by equality."""
    ends = daily.where(F.col("day").isNotNull()).groupBy("country").agg(F.min("day").alias("min"), F.max("day").alias("max"))
    spine = ends.select("country", F.explode(F.sequence("min", "max")).alias("day"))
    upto = F.sum(F.coalesce("spend", F.lit(0))).over(Window.partitionBy("country").orderBy("day"))
    return spine.join(daily, ["country", "day"], "left").select("country", "day", upto.alias("upto"))


def range_sum_spend(ranges: DataFrame, daily: DataFrame, keys: Sequence[str], out: str = "spend") -> DataFrame:
    """Spend inside each inclusive range, 0 for an empty or missing one.

    The difference of two running sums: one at the range's last day, one at the day before
    its first, both cut to the days with spend. Each is found by an equality join, so a
    range is one row however long it is; a range condition would compare every range
    with every day.
    """
    known = daily.where(F.col("day").isNotNull()).groupBy("country").agg(F.min("day").alias("__min"), F.max("day").alias("__max"))
    whole = F.col("from") <= F.col("to")
    ends = ranges.join(known, "country", "left").select(
        "country", *keys,
        F.when(whole, F.least("to", "__max")).alias("__last"),
        F.when(whole, F.date_sub(F.greatest("from", "__min"), 1)).alias("__before"),
    )
    sums = spend_to_date(daily)
    at = lambda end: sums.select("country", F.col("day").alias(f"__{end}"), F.col("upto").alias(f"__upto_{end}"))
    met = ends.join(at("last"), ["country", "__last"], "left").join(at("before"), ["country", "__before"], "left")
    # A range that ends before the first spend, or begins after the last, has its ends crossed.
    inside = F.when(F.col("__last") > F.col("__before"), F.col("__upto_last") - F.coalesce("__upto_before", F.lit(0)))
    return met.groupBy("country", *keys).agg(F.coalesce(F.sum(inside), F.lit(0)).alias(out))


def daily_spend(spend: DataFrame, first: dt.date, as_of: dt.date) -> DataFrame:
    """Whole spend units per country and day."""
    return scan_spend(spend, first, as_of).groupBy("country", "day").agg(
        F.round(F.sum("spend"), 0).cast("long").alias("spend")
    )
