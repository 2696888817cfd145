"""Scans, labels, calendar functions and period selection."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from funnelloom.catalog.registry import (
    SQL_GRAINS,
    VIEWS,
    query,
    sql_bucket,
    sql_grain_start,
)
from funnelloom.functions import dates, text
from funnelloom.operators import events, joins, rollup, scans
from funnelloom.plans import weekly
from funnelloom.session import scratch_path
from funnelloom.sources.readers import load_result_rows as load_rows
from funnelloom.sources.testdata import AS_OF
from funnelloom.sources.writers import write_json
from funnelloom.spec import (
    CO,
    LABELS_ASSIGNED_CO,
    LABELS_EXPLORER,
    LABELS_HOURLY,
    LABELS_REVIEW,
    MX,
)

D = f"DATE '{AS_OF}'"
_BASE = "SELECT country, deal_id, asset_id, source_id, CAST(created AS STRING) AS created FROM v_base"


def _text(df, *names):
    return df.withColumns({n: F.col(n).cast("string") for n in names})


# --- scans ------------------------------------------------------------------------------
@query("scan_leads", _BASE)
def scan_leads(t):
    rows = scans.scan_leads(t.leads, AS_OF)
    return _text(rows.select("country", "deal_id", "asset_id", "source_id", "created"), "created")


def _warehouse(t, spec):
    """One country's leads under that country's own column names."""
    names = {ours: theirs for theirs, ours in spec.columns.items()}
    rows = t.leads.where(F.col("country") == spec.code)
    return rows.select(*[F.col(ours).alias(theirs) for ours, theirs in names.items()])


_CANONICAL = """SELECT country, deal_id, asset_id, source_id, source_name, campaign,
  CAST(created_at AS STRING) AS created_at FROM v_leads"""


def _canonical(t, spec):
    return scans.scan_canonical_country(_warehouse(t, spec), spec)


@query("scan_canonical_country", f"{_CANONICAL} WHERE country = 'MX'")
def scan_canonical_country(t):
    return _text(_canonical(t, MX), "created_at")


@query("union_countries", _CANONICAL)
def union_countries(t):
    both = scans.union_countries([_canonical(t, CO), _canonical(t, MX)])
    return _text(both, "created_at")


@query(
    "scan_state_log",
    """SELECT country, deal_id, state_id, CAST(ts AS STRING) AS ts FROM v_state_log_mm
    WHERE state_id IN (20, 63) AND deal_id IS NOT NULL""",
)
def scan_state_log(t):
    rows = scans.scan_state_log(t.state_log_mm, (20, 63))
    return _text(rows.select("country", "deal_id", "state_id", "ts"), "ts")


_S0, _S1 = AS_OF - dt.timedelta(days=180), AS_OF


@query(
    "scan_spend",
    f"""SELECT country, CAST(CAST(date AS DATE) AS STRING) AS day, campaign, CAST(spend AS DOUBLE) AS spend
    FROM v_spend WHERE date >= DATE '{_S0}' AND date < DATE '{_S1}'""",
)
def scan_spend(t):
    rows = scans.scan_spend(t.spend, _S0, _S1)
    return _text(rows.select("country", "day", "campaign", F.col("spend").cast("double")), "day")


@query("load_result_rows", "SELECT * REPLACE (CAST(spend AS BIGINT) AS spend) FROM v_by_source")
def load_result_rows(t):
    """The weekly board stored with text numbers, as a warehouse client returns it."""
    board = weekly.weekly_by_source(t.leads, t.state_log_mm, t.assigned_mart, t.spend, AS_OF)
    path = scratch_path(t.spark, "result-rows")
    write_json(board.select(*[F.col(c).cast("string").alias(c) for c in board.columns]), path)
    schema = "country string, week_start string, source string, reg long, cal long, asg long, spend long"
    return load_rows(t.spark, path, schema)


# --- labels and text ----------------------------------------------------------------------
def _case(labels: dict[int, str]) -> str:
    arms = " ".join(f"WHEN {k} THEN '{v}'" for k, v in labels.items())
    return f"CASE source_id {arms} END"


_SETS = {
    "review": LABELS_REVIEW,
    "hourly": LABELS_HOURLY,
    "assigned": LABELS_ASSIGNED_CO,
    "explorer": LABELS_EXPLORER,
}


@query(
    "label_source",
    f"""SELECT deal_id, source_id, {', '.join(f'{_case(m)} AS {n}' for n, m in _SETS.items())} FROM v_leads""",
)
def label_source(t):
    labels = [text.label_source(F.col("source_id"), m).alias(n) for n, m in _SETS.items()]
    return t.leads.select("deal_id", "source_id", *labels)


@query(
    "string_ops",
    """SELECT deal_id, lower(trim(state_text)) AS a, replace(state_text, '_', ' ') AS b,
    source_name || ' Direct' AS c, CAST(asset_id AS STRING) AS d FROM v_leads""",
)
def string_ops(t):
    state = F.col("state_text")
    return t.leads.select(
        "deal_id",
        F.lower(F.trim(state)).alias("a"),
        F.translate(state, "_", " ").alias("b"),
        F.concat("source_name", F.lit(" Direct")).alias("c"),
        F.col("asset_id").cast("string").alias("d"),
    )


# --- calendar ---------------------------------------------------------------------------------
def _calendar(key: str, sql: str, build) -> None:
    @query(
        key,
        f"SELECT CAST({sql} AS STRING) AS bucket, min(created_at)::STRING AS first, count(*) AS n FROM v_leads GROUP BY 1",
    )
    def calendar(t):
        bucket = build(F.to_date("created_at")).cast("string").alias("bucket")
        rows = t.leads.groupBy(bucket).agg(F.min("created_at").alias("first"), F.count("*").alias("n"))
        return _text(rows, "first")


_calendar("iso_week_start", sql_bucket("created_at", "W"), dates.iso_week_start)
_calendar("commercial_week_start", sql_bucket("created_at", "C"), dates.commercial_week_start)
_calendar("month_start", sql_bucket("created_at", "M"), dates.month_start)
_calendar("month_key", "strftime(created_at, '%Y-%m')", dates.month_key)
_calendar("quarter_key", "concat(year(created_at), '-Q', quarter(created_at))", dates.quarter_key)
_calendar("year_key", "year(created_at)", dates.year_key)


# --- period selection ---------------------------------------------------------------------------
VIEWS["latest"] = f"""
SELECT * FROM (SELECT DISTINCT g, {sql_grain_start('created')} AS start FROM v_base CROSS JOIN {SQL_GRAINS})
QUALIFY g = 'Y' OR row_number() OVER (PARTITION BY g ORDER BY start DESC) <= 25"""


@query("latest_periods", "SELECT g, CAST(start AS STRING) AS start FROM v_latest")
def latest_periods(t):
    return _text(rollup.latest_periods(scans.scan_leads(t.leads, AS_OF)), "start")


@query(
    "semi_in_periods",
    f"""SELECT country, deal_id, CAST({sql_bucket('created', 'W')} AS STRING) AS week FROM v_base
    WHERE {sql_bucket('created', 'W')} IN (SELECT start FROM v_latest WHERE g = 'W')""",
)
def semi_in_periods(t):
    rows = scans.scan_leads(t.leads, AS_OF).withColumn("week", dates.iso_week_start(F.col("created")))
    out = joins.semi_in_latest(rows, "week", 25)
    return _text(out.select("country", "deal_id", "week"), "week")


@query(
    "flag_open_period",
    f"""SELECT DISTINCT g, CAST(start AS STRING) AS start, start = {sql_grain_start(D)} AS open_period FROM (
    SELECT g, {sql_grain_start('created_at')} AS start FROM v_leads CROSS JOIN {SQL_GRAINS})""",
)
def flag_open_period(t):
    days = t.leads.select(F.to_date("created_at").alias("d")).distinct()
    buckets = rollup.explode_grains(days, "d", ()).distinct()
    return _text(buckets.withColumn("open_period", dates.flag_open_period(AS_OF)), "start")


_WINDOWS = {"d40": (40, 0, False), "d140": (140, 0, True), "d364": (364, 0, False), "w18": (0, 18, True)}


def _window_sql(days: int, weeks: int, to_week: bool) -> str:
    return f"DATE '{dates.lookback_start(AS_OF, days, weeks, to_week)}'"


@query(
    "lookback_window",
    "SELECT country, "
    + ", ".join(
        f"count(*) FILTER (created >= {_window_sql(*w)}) AS {n}" for n, w in _WINDOWS.items()
    )
    + " FROM v_base GROUP BY country",
)
def lookback_window(t):
    rows = scans.scan_leads(t.leads, AS_OF)
    counts = [
        F.count_if(F.col("created") >= F.lit(dates.lookback_start(AS_OF, *w))).alias(n)
        for n, w in _WINDOWS.items()
    ]
    return rows.groupBy("country").agg(*counts)


@query(
    "anti_missing_second_track",
    """SELECT b.country, b.deal_id, b.source_id FROM v_base b
    JOIN v_first_mm m ON m.country = b.country AND m.deal_id = b.deal_id
    LEFT JOIN v_first_inmo i ON i.country = b.country AND i.deal_id = b.deal_id WHERE i.deal_id IS NULL""",
)
def anti_missing_second_track(t):
    keys = list(events.DEAL)
    base = scans.scan_leads(t.leads, AS_OF).where(F.col("deal_id").isNotNull())
    on_first = base.join(events.first_event(t.state_log_mm, (20, 63)).select(*keys), keys, "left_semi")
    second = events.first_event(t.state_log_inmo, (20,)).select(*keys)
    return on_first.join(second, keys, "left_anti").select("country", "deal_id", "source_id")


@query(
    "ordered_output",
    """WITH k AS (SELECT b.country, b.source_id, strftime(b.created, '%Y-%m') AS p, c.state_id, count(*) AS n
      FROM v_base b JOIN v_current_mm c ON c.country = b.country AND c.deal_id = b.deal_id
      WHERE c.state_id NOT IN (20, 63) GROUP BY ALL)
    SELECT country, source_id, p, state_id, n FROM k ORDER BY country, source_id, p, n DESC, state_id""",
)
def ordered_output(t):
    current = events.latest_state(t.state_log).where(~F.col("state_id").isin(20, 63))
    base = scans.scan_leads(t.leads, AS_OF).select("country", "deal_id", "source_id", "created")
    month = dates.month_key(F.col("created")).alias("p")
    rows = base.join(current, list(events.DEAL)).groupBy("country", "source_id", month, "state_id")
    return rows.agg(F.count("*").alias("n")).orderBy("country", "source_id", "p", F.desc("n"), "state_id")
