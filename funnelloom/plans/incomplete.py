"""Incomplete leads: share, missing attributes, recovery by agent, property types."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from funnelloom.functions.dates import bucket_sql, grain_label
from funnelloom.functions.ratios import pct, share_band
from funnelloom.operators.compare import change_latest, row_max_band
from funnelloom.spec import (
    COMPLETENESS_ATTRS,
    INFORMATIVE_ATTRS,
    PROPERTY_TYPES,
    RECOVERY_AGENTS,
)

ATTRS = (*COMPLETENESS_ATTRS, *INFORMATIVE_ATTRS)
SHOWN = 20
# Incomplete now, incomplete an hour after creation, and recovered later than that.
_NOW = "incomplete_at IS NOT NULL AND completed_at IS NULL"
_HOUR = (
    "incomplete_at IS NOT NULL AND "
    "(completed_at IS NULL OR completed_at > created_at + INTERVAL '60' MINUTE)"
)
_RECOVERED = "incomplete_at IS NOT NULL AND completed_at > created_at + INTERVAL '60' MINUTE"


def _type_key() -> str:
    known = ", ".join(t for t in PROPERTY_TYPES if t.isdigit())
    return (
        f"CASE WHEN type IS NULL THEN 'none' WHEN type IN ({known}) THEN CAST(type AS STRING) "
        "ELSE 'other' END"
    )


def _agent_key() -> str:
    known = ", ".join(f"'{a}'" for a in RECOVERY_AGENTS if a != "others")
    return f"CASE WHEN agent IN ({known}) THEN agent ELSE 'others' END"


def profile_metrics() -> dict[str, str]:
    out = {"total": "true", "incomplete": _NOW, "incomplete_60m": _HOUR, "recovered": _RECOVERED}
    out |= {f"no_{a}": f"{a} IS NULL" for a in ATTRS}
    out |= {f"ag_{a}": f"{_RECOVERED} AND {_agent_key()} = '{a}'" for a in RECOVERY_AGENTS}
    out |= {f"tp_{t}": f"{_type_key()} = '{t}'" for t in PROPERTY_TYPES}
    out |= {f"ip_{t}": f"{_type_key()} = '{t}' AND {_NOW}" for t in PROPERTY_TYPES}
    return out


def incomplete_profile(profiles: DataFrame) -> DataFrame:
    """Counts per grain, bucket and source. Leads are counted per day in one pass; the
    daily table is then summed into weeks and months."""
    metrics = profile_metrics()
    daily = (
        profiles.where("created_at IS NOT NULL")
        .groupBy("source_id", F.to_date("created_at").alias("d"))
        .agg(*[F.expr(f"count_if({test}) AS {name}") for name, test in metrics.items()])
    )
    structs = ", ".join(f"named_struct('g', '{g}', 'start', {bucket_sql('d', g)})" for g in "DWM")
    rows = daily.selectExpr("source_id", *metrics, f"inline(array({structs}))")
    return rows.groupBy("g", "start", "source_id").agg(
        *[F.expr(f"sum({m}) AS {m}") for m in metrics]
    )


def page_rows(profile: DataFrame, shown: int = SHOWN) -> DataFrame:
    """All sources together, the last buckets of each grain."""
    metrics = list(profile_metrics())
    sums = profile.groupBy("g", "start").agg(*[F.expr(f"sum({m}) AS {m}") for m in metrics])
    recent = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("start")))
    return sums.withColumn("__r", recent).where(F.col("__r") <= shown).drop("__r")


def incomplete_rates(page: DataFrame) -> DataFrame:
    zero = F.lit(0.0)
    return page.select(
        "g",
        "start",
        grain_label().alias("p"),
        "total",
        "incomplete",
        "incomplete_60m",
        "recovered",
        F.coalesce(pct(F.col("incomplete"), F.col("total")), zero).alias("pct_incomplete"),
        F.coalesce(pct(F.col("incomplete_60m"), F.col("total")), zero).alias("pct_60m"),
        F.coalesce(pct(F.col("recovered"), F.col("incomplete_60m")), zero).alias("pct_recovered"),
    )


def _long(page: DataFrame, prefix: str, names: tuple[str, ...], name: str, base: str) -> DataFrame:
    cells = ", ".join(f"named_struct('{name}', '{n}', 'n', {prefix}_{n})" for n in names)
    return page.selectExpr("g", "start", f"{base} AS base", f"inline(array({cells}))")


def missing_attributes(page: DataFrame) -> DataFrame:
    """Share of leads without each attribute, relative to that attribute's own maximum."""
    rows = _long(page, "no", ATTRS, "attribute", "total")
    rate = F.coalesce(pct(F.col("n"), F.col("base")), F.lit(0.0))
    return row_max_band(rows.withColumn("rate", rate), ["g", "attribute"], "rate", share_band)


def recovery_by_agent(page: DataFrame) -> DataFrame:
    """Recovered leads by agent and their share; agents without any are left out."""
    rows = _long(page, "ag", RECOVERY_AGENTS, "agent", "recovered")
    rate = F.coalesce(pct(F.col("n"), F.col("base")), F.lit(0.0))
    total = F.sum("n").over(Window.partitionBy("g", "agent"))
    rows = rows.withColumn("rate", rate).withColumn("agent_total", total)
    return row_max_band(rows.where(F.col("agent_total") > 0), ["g", "agent"], "rate", share_band)


def type_by_incomplete(page: DataFrame) -> DataFrame:
    """Property types over the shown buckets, for all leads and for incomplete ones."""
    cells = ", ".join(f"named_struct('type', '{t}', 'n', tp_{t}, 'inc', ip_{t})" for t in PROPERTY_TYPES)
    rows = page.selectExpr("g", f"inline(array({cells}))")
    sums = rows.groupBy("g", "type").agg(F.sum("n").alias("total"), F.sum("inc").alias("incomplete"))
    return sums.where((F.col("total") > 0) | (F.col("incomplete") > 0))


def change_in_share(page: DataFrame) -> DataFrame:
    """Points between the last two buckets, on shares rounded to one decimal as shown."""
    rates = incomplete_rates(page).select(
        "g", "start", F.round(F.col("pct_incomplete").cast("decimal(20,10)"), 1).alias("share")
    )
    return change_latest(rates, ["g"], "start", "share")


def top_missing_attribute(page: DataFrame) -> DataFrame:
    """Completeness attribute that is missing most often in the last bucket. Ties go to
    the attribute listed first."""
    last = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("start")))
    newest = page.withColumn("__r", last).where(F.col("__r") == 1)
    cells = ", ".join(
        f"named_struct('pos', {i}, 'attribute', '{a}', 'n', no_{a})" for i, a in enumerate(COMPLETENESS_ATTRS)
    )
    rows = newest.selectExpr("g", "start", "incomplete", f"inline(array({cells}))")
    best = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("n"), "pos"))
    return rows.withColumn("__b", best).where(F.col("__b") == 1).drop("__b", "pos")
