"""Ratios, deltas and bands as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from funnelloom.spec import SIGNIFICANCE


def safe_ratio(num: Column, den: Column) -> Column:
    """Quotient, NULL where the denominator is 0 or NULL."""
    return F.when(den > 0, num.cast("double") / den.cast("double"))


def pct(num: Column, den: Column) -> Column:
    """Percentage; the factor is applied first so that both engines agree bit by bit."""
    return F.when(den > 0, F.lit(100.0) * num.cast("double") / den.cast("double"))


def round_half_up(x: Column) -> Column:
    """Nearest whole number, halves towards plus infinity."""
    return F.floor(x + F.lit(0.5))


def yoy_pct(current: Column, previous: Column) -> Column:
    """Whole percentage change; NULL without a base or a current value."""
    cur, prev = current.cast("double"), previous.cast("double")
    return F.when(
        current.isNotNull() & previous.isNotNull() & (previous != 0),
        round_half_up((cur - prev) / prev * F.lit(100.0)),
    )


def is_new(current: Column, previous: Column) -> Column:
    """True where something appeared from nothing."""
    return F.coalesce((previous == 0) & (current != 0), F.lit(False))


def delta_pct(current: Column, previous: Column) -> Column:
    """Relative change: NULL when undefined, infinite when the previous value is 0."""
    cur, prev = current.cast("double"), previous.cast("double")
    return (
        F.when(current.isNull() | previous.isNull(), F.lit(None).cast("double"))
        .when((prev == 0) & (cur == 0), F.lit(None).cast("double"))
        .when(prev == 0, F.lit(float("inf")))
        .otherwise((cur - prev) / prev)
    )


def significance_flag(delta: Column, direction: Column | str) -> Column:
    """Good, bad or neutral by a strict threshold and the metric's direction."""
    way = F.lit(direction) if isinstance(direction, str) else direction
    up, down = delta > SIGNIFICANCE, delta < -SIGNIFICANCE
    new = delta == F.lit(float("inf"))
    return (
        F.when((way == "none") | delta.isNull(), F.lit("neutral"))
        .when(new, F.lit("good"))
        .when((way == "up") & up, F.lit("good"))
        .when((way == "up") & down, F.lit("bad"))
        .when((way == "down") & down, F.lit("good"))
        .when((way == "down") & up, F.lit("bad"))
        .otherwise(F.lit("neutral"))
    )


def quality_band(share: Column) -> Column:
    return F.when(share < 10, "good").when(share < 20, "warn").when(share.isNotNull(), "bad")


def attainment_band(share: Column) -> Column:
    return F.when(share >= 95, "good").when(share >= 80, "warn").when(share.isNotNull(), "bad")


def share_band(ratio: Column) -> Column:
    """Band of a rate relative to its own maximum."""
    return F.when(ratio > 0.8, "high").when(ratio > 0.5, "mid").otherwise("low")
