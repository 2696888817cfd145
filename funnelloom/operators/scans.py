"""Row selection at the sources: bounds on raw columns, so they reach the scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelloom.functions.dates import start_of_day
from funnelloom.spec import COUNTRIES, CountrySpec


def official_source(specs: Iterable[CountrySpec] = COUNTRIES, wide: bool = False) -> Column:
    """True for rows of a country in one of that country's official sources."""
    test = None
    for spec in specs:
        ids = spec.wide_source_ids if wide else spec.source_ids
        one = (F.col("country") == spec.code) & F.col("source_id").isin(*ids)
        test = one if test is None else test | one
    return test


def scan_leads(
    leads: DataFrame,
    as_of: dt.date,
    specs: Iterable[CountrySpec] = COUNTRIES,
    first: dt.date | None = None,
    wide: bool = False,
) -> DataFrame:
    """Leads of official sources with a creation date before ``as_of``."""
    keep = F.col("created_at").isNotNull() & (F.col("created_at") < start_of_day(as_of))
    if first is not None:
        keep = keep & (F.col("created_at") >= start_of_day(first))
    return leads.where(keep & official_source(specs, wide)).withColumn(
        "created", F.to_date("created_at")
    )


def scan_state_log(log: DataFrame, states: Sequence[int], track: str | None = None) -> DataFrame:
    keep = F.col("deal_id").isNotNull() & F.col("state_id").isin(*states)
    if track is not None:
        keep = keep & (F.col("track") == track)
    return log.where(keep)


def scan_spend(spend: DataFrame, first: dt.date, last_exclusive: dt.date) -> DataFrame:
    return spend.where(
        (F.col("date") >= start_of_day(first)) & (F.col("date") < start_of_day(last_exclusive))
    ).withColumn("day", F.to_date("date"))


def scan_canonical_country(df: DataFrame, spec: CountrySpec, columns: dict[str, str] | None = None) -> DataFrame:
    """One country's table in canonical column names with its country tag."""
    names = columns or spec.columns
    kept = [F.col(theirs).alias(ours) for theirs, ours in names.items() if theirs in df.columns]
    return df.select(F.lit(spec.code).alias("country"), *kept)


def union_countries(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def country_label(country: Column, attribute: str = "label") -> Column:
    """Country code to one of its display names."""
    out = None
    for spec in COUNTRIES:
        value = F.lit(getattr(spec, attribute))
        test = country == spec.code
        out = F.when(test, value) if out is None else out.when(test, value)
    return out


def mart_country_code(label: Column) -> Column:
    """Country name of the assigned mart to country code."""
    out = None
    for spec in COUNTRIES:
        test = label == spec.mart_label
        out = F.when(test, F.lit(spec.code)) if out is None else out.when(test, F.lit(spec.code))
    return out
