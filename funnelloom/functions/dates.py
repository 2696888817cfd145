"""Calendar buckets, local time and period arithmetic as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelloom.spec import GRAINS


def start_of_day(day: dt.date) -> Column:
    """Day as a zoneless timestamp literal, so that raw timestamp columns can be
    compared without a cast and the bound reaches the file scan."""
    return F.lit(f"{day:%Y-%m-%d} 00:00:00").cast("timestamp_ntz")


def iso_week_start(d: Column) -> Column:
    return F.trunc(d, "WEEK")


def commercial_week_start(d: Column) -> Column:
    """Wednesday that opens the Wednesday-to-Tuesday cycle."""
    return F.date_sub(d, (F.dayofweek(d) + F.lit(3)) % 7)


def month_start(d: Column) -> Column:
    return F.trunc(d, "MONTH")


def quarter_start(d: Column) -> Column:
    return F.trunc(d, "QUARTER")


def year_start(d: Column) -> Column:
    return F.trunc(d, "YEAR")


def month_key(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def quarter_key(d: Column) -> Column:
    return F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))


def year_key(d: Column) -> Column:
    return F.year(d).cast("string")


_STARTS = {
    "D": lambda d: d,
    "W": iso_week_start,
    "C": commercial_week_start,
    "M": month_start,
    "Q": quarter_start,
    "Y": year_start,
}
_LABELS = {
    "M": month_key,
    "Q": quarter_key,
    "Y": year_key,
}


def bucket_sql(day: str, grain: str) -> str:
    """``bucket_start`` as SQL text, for expressions built in one piece."""
    return {
        "D": day,
        "W": f"trunc({day}, 'WEEK')",
        "C": f"date_sub({day}, (dayofweek({day}) + 3) % 7)",
        "M": f"trunc({day}, 'MONTH')",
        "Q": f"trunc({day}, 'QUARTER')",
        "Y": f"trunc({day}, 'YEAR')",
    }[grain]


def bucket_start(d: Column, grain: str) -> Column:
    """First day of the bucket that holds ``d``."""
    return _STARTS[grain](d)


def bucket_label(start: Column, grain: str) -> Column:
    """Text shown for a bucket; day, week and cycle buckets show their first day."""
    return _LABELS.get(grain, lambda s: s.cast("string"))(start)


def grain_label(grain: str = "g", start: str = "start") -> Column:
    """``bucket_label`` for rows of mixed grain, by column names."""
    return F.expr(
        f"CASE {grain} WHEN 'M' THEN date_format({start}, 'yyyy-MM') "
        f"WHEN 'Q' THEN concat(year({start}), '-Q', quarter({start})) "
        f"WHEN 'Y' THEN CAST(year({start}) AS STRING) ELSE CAST({start} AS STRING) END"
    )


def bucket_of_day(day: dt.date, grain: str) -> dt.date:
    """The same bucket start for a parameter date, on the driver."""
    if grain == "W":
        return day - dt.timedelta(days=day.weekday())
    if grain == "C":
        return day - dt.timedelta(days=(day.weekday() + 5) % 7)
    if grain == "M":
        return day.replace(day=1)
    if grain == "Q":
        return day.replace(month=3 * ((day.month - 1) // 3) + 1, day=1)
    if grain == "Y":
        return day.replace(month=1, day=1)
    return day


def exclude_open_period(df: DataFrame, bucket: str, as_of: dt.date, grain: str) -> DataFrame:
    return df.where(F.col(bucket) < F.lit(bucket_of_day(as_of, grain)))


def flag_open_period(as_of: dt.date, grain: str = "g", start: str = "start") -> Column:
    """True for the bucket that contains ``as_of``, whatever the row's grain."""
    arms = " ".join(f"WHEN '{g}' THEN DATE '{bucket_of_day(as_of, g)}'" for g in GRAINS)
    return F.expr(f"{start} = CASE {grain} {arms} END")


def lookback_start(as_of: dt.date, days: int = 0, weeks: int = 0, to_week: bool = False) -> dt.date:
    """First day of a look-back window, optionally moved back to its Monday."""
    start = as_of - dt.timedelta(days=days, weeks=weeks)
    return bucket_of_day(start, "W") if to_week else start


def local_timestamp(ts: Column, offset_hours: int) -> Column:
    """Zoneless UTC timestamp moved by a fixed offset."""
    return ts + F.make_dt_interval(hours=F.lit(offset_hours))


def local_date(ts: Column, offset_hours: int) -> Column:
    return F.to_date(local_timestamp(ts, offset_hours))


def local_hour(ts: Column, offset_hours: int) -> Column:
    """Hour of the local day on a 1 to 24 axis."""
    return F.hour(local_timestamp(ts, offset_hours)) + 1


def local_date_tz(ts: str, kind: T.DataType, zone: str) -> Column:
    """Local date of a time column in a named zone. An instant is one whatever the session's
    zone; a zoneless time, or a date, is taken as UTC."""
    utc = f"CAST({ts} AS TIMESTAMP_NTZ)"
    if isinstance(kind, T.TimestampType):
        utc = f"(TIMESTAMP_NTZ '1970-01-01 00:00:00' + INTERVAL '0.000001' SECOND * unix_micros({ts}))"
    return F.expr(f"CAST(convert_timezone('UTC', '{zone}', {utc}) AS DATE)")


def date_spine(spark: SparkSession, first: dt.date, last: dt.date, name: str = "d") -> DataFrame:
    """All days between two parameter dates, both included."""
    days = (last - first).days + 1
    return spark.range(max(days, 0)).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias(name)
    )


def bucket_spine(df: DataFrame, first: str, last: str, grain: str, name: str = "bucket") -> DataFrame:
    """One row per bucket between the two date columns of each row."""
    step = {"D": "1 day", "W": "7 days", "M": "1 month"}[grain]
    return df.withColumn(
        name,
        F.explode(
            F.sequence(
                bucket_start(F.col(first), grain), bucket_start(F.col(last), grain),
                F.expr(f"INTERVAL {step}"),
            )
        ),
    )


def replace_year(d: Column, year: Column | int) -> Column:
    """Same month and day in another year, NULL when that day does not exist."""
    y = F.lit(year) if isinstance(year, int) else year
    no_leap_day = (F.month(d) == 2) & (F.dayofmonth(d) == 29) & ~_is_leap(y)
    day = F.when(no_leap_day, F.lit(None).cast("int")).otherwise(F.dayofmonth(d))
    return F.make_date(y, F.month(d), day)


def replace_year_clamped(d: Column, year: Column | int) -> Column:
    """Same month and day in another year, 29 February moved to the 28th."""
    return F.coalesce(replace_year(d, year), F.date_sub(_next_year_mar1(year), 1))


def _next_year_mar1(year: Column | int) -> Column:
    y = F.lit(year) if isinstance(year, int) else year
    return F.make_date(y, F.lit(3), F.lit(1))


def _is_leap(y: Column) -> Column:
    return ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)


def prior_year_range(first: Column, last: Column, year: int) -> tuple[Column, Column]:
    """A range moved to ``year``.

    Nothing moves when the first day already lies in that year. A bound that does
    not exist there makes the whole range NULL, which sums to nothing.
    """
    same = F.year(first) == year
    moved_first, moved_last = replace_year(first, year), replace_year(last, year)
    broken = moved_first.isNull() | moved_last.isNull()
    gone = F.lit(None).cast("date")
    return (
        F.when(same, first).when(broken, gone).otherwise(moved_first),
        F.when(same, last).when(broken, gone).otherwise(moved_last),
    )


def cap_to_yesterday(first: Column, last: Column, as_of: dt.date) -> tuple[Column, Column]:
    """Clip a current-year range at the day before ``as_of``; a future one is NULL."""
    cap = F.lit(as_of - dt.timedelta(days=1))
    gone = F.lit(None).cast("date")
    return (
        F.when(first <= cap, first).otherwise(gone),
        F.when(first <= cap, F.least(last, cap)).otherwise(gone),
    )


def unix_micros_sql(ts: str, kind: T.DataType) -> str:
    """SQL for the microseconds of a time since 1970. A zoneless one is counted as it
    stands, so that neither order nor distance depends on the session's zone."""
    if isinstance(kind, T.TimestampType):
        return f"unix_micros({ts})"
    passed = f"CAST(CAST({ts} AS TIMESTAMP_NTZ) - TIMESTAMP_NTZ '1970-01-01 00:00:00' AS INTERVAL SECOND)"
    return f"CAST(CAST({passed} AS DECIMAL(18,6)) * 1000000 AS BIGINT)"
