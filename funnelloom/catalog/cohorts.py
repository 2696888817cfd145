"""Cohort boards and the multi-grain operators behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from funnelloom.catalog.registry import (
    SQL_GRAINS,
    VIEWS,
    board,
    query,
    sql_bucket,
    sql_grain_label,
    sql_grain_start,
)
from funnelloom.functions.dates import iso_week_start
from funnelloom.operators import events, rollup
from funnelloom.operators.joins import left_join_spread
from funnelloom.operators.scans import scan_leads
from funnelloom.plans import sellers
from funnelloom.sources.testdata import AS_OF

D = f"DATE '{AS_OF}'"

# --- oracle helper views --------------------------------------------------------------
VIEWS["base"] = f"""
SELECT *, CAST(created_at AS DATE) AS created FROM v_leads
WHERE created_at IS NOT NULL AND created_at < {D}
  AND ((country = 'CO' AND source_id IN (3,7,20,35,39,47))
    OR (country = 'MX' AND source_id IN (3,7,35,39,46,47)))"""
VIEWS["first_mm"] = """
SELECT country, deal_id, min(ts) AS first_at FROM v_state_log_mm
WHERE state_id IN (20, 63) AND deal_id IS NOT NULL GROUP BY ALL"""
VIEWS["first_inmo"] = """
SELECT country, deal_id, min(ts) AS first_at FROM v_state_log_inmo
WHERE state_id = 20 AND deal_id IS NOT NULL GROUP BY ALL"""
for _track in ("mm", "inmo"):
    VIEWS[f"current_{_track}"] = f"""
SELECT country, deal_id, state_id FROM v_state_log_{_track} WHERE deal_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY country, deal_id
  ORDER BY ts DESC, seq DESC, state_id DESC) = 1"""
    _column = "state_id" if _track == "mm" else "inmo_state_id"
    VIEWS[f"stored_{_track}"] = f"SELECT country, deal_id, {_column} AS state_id FROM v_deal_states WHERE deal_id IS NOT NULL"
VIEWS["first_asg"] = """
SELECT country, asset_id, min(CAST(ts AS DATE)) AS assigned_date FROM v_stage_log
WHERE (country = 'CO' AND stage = 'Primer_asigancion' AND team = 'Exclusivo inmobiliaria CO')
   OR (country = 'MX' AND stage = 'Primer asignacion' AND team IN ('Inmobiliaria 1',
       'Inmobiliaria 2', 'Inmo ciudades MX', 'Inmobliaria mx', 'Inmo puebla'))
GROUP BY ALL"""
VIEWS["enriched"] = """
SELECT b.*, CAST(m.first_at AS DATE) AS mm_date, CAST(i.first_at AS DATE) AS inmo_date,
  a.assigned_date, c.state_id AS cur
FROM v_base b
LEFT JOIN v_first_mm m ON m.country = b.country AND m.deal_id = b.deal_id
LEFT JOIN v_first_inmo i ON i.country = b.country AND i.deal_id = b.deal_id
LEFT JOIN v_first_asg a ON a.country = b.country AND a.asset_id = b.asset_id
LEFT JOIN v_current_mm c ON c.country = b.country AND c.deal_id = b.deal_id"""


def sql_label(country: str = "country") -> str:
    return f"CASE {country} WHEN 'CO' THEN 'Colombia' ELSE 'México' END"


def by_grain(table: str, keys: str, metrics: str) -> str:
    """Aggregate at six grains and keep the latest buckets, as CTE ``kept``."""
    return f"""
agg AS (
  SELECT g, {sql_grain_start('created')} AS start, {keys}, {metrics}
  FROM {table} CROSS JOIN {SQL_GRAINS} GROUP BY ALL),
kept AS (
  SELECT *, {sql_grain_label('start')} AS p FROM agg
  QUALIFY g = 'Y' OR dense_rank() OVER (PARTITION BY g ORDER BY start DESC) <= 25)"""


# --- minimum slice ----------------------------------------------------------------------
@query(
    "cohort_weekly",
    f"""SELECT country, source_id, CAST({sql_bucket('created', 'W')} AS STRING) AS week,
    count(*) AS reg, count(*) FILTER (mm_date IS NOT NULL) AS cal FROM v_enriched GROUP BY ALL""",
)
def cohort_weekly(t):
    base = scan_leads(t.leads, AS_OF).select("country", "deal_id", "source_id", "created")
    first = events.first_event_date(t.state_log_mm, (20, 63))
    rows = left_join_spread(base, first, on=events.DEAL, nullable="deal_id")
    return rows.groupBy(
        "country", "source_id", iso_week_start(F.col("created")).cast("string").alias("week")
    ).agg(F.count("*").alias("reg"), F.count("first_date").alias("cal"))


# --- Q1 ---------------------------------------------------------------------------------
_SELLERS = """count(*) AS tr, count(DISTINCT asset_id) AS t,
  count(*) FILTER (mm_date IS NOT NULL) AS cal_mm,
  count(*) FILTER (inmo_date IS NOT NULL) AS cal_inmo,
  count(*) FILTER (assigned_date IS NOT NULL) AS asg_inmo,
  count(*) FILTER (mm_date IS NOT NULL AND inmo_date IS NULL) AS cal_mm_no_inmo,
  count(*) FILTER (mm_date IS NOT NULL AND cur = 1) AS cal_mm_dup,
  count(*) FILTER (mm_date IS NOT NULL AND cur IN (3,10,16,33,38,55,56,61,64)) AS cal_mm_desc,
  count(*) FILTER (cur = 7) AS incomp, count(*) FILTER (cur = 1) AS dup"""
_SELLERS_SQL = f"""WITH {by_grain('v_enriched', 'country, source_id, min(source_name) AS fn', _SELLERS)}
SELECT g, {sql_label()} AS c, source_id AS f, fn, p, tr, t, cal_mm, cal_inmo, asg_inmo,
  cal_mm_no_inmo, cal_mm_dup, cal_mm_desc, incomp, dup FROM kept"""


@board("sellers_funnel", _SELLERS_SQL)
def sellers_funnel(t, current):
    return sellers.sellers_funnel(t.leads, t.state_log, t.stage_log, AS_OF, current)


@board(
    "cohort_multi_grain",
    f"""WITH {by_grain('v_enriched', 'country, source_id', '''count(*) AS tr,
      count(DISTINCT asset_id) AS t, count(*) FILTER (mm_date IS NOT NULL) AS cal_mm''')}
    SELECT g, country, source_id, p, tr, t, cal_mm FROM kept""",
)
def cohort_multi_grain(t, current):
    base = sellers.enrich_first_events(t.leads, t.state_log, t.stage_log, AS_OF, current)
    out = rollup.cohort_by_grain(base, {"cal_mm": "mm_date IS NOT NULL"}, name=None)
    return out.select("g", "country", "source_id", "p", "tr", "t", "cal_mm")


@board(
    "enrich_first_events",
    """SELECT deal_id, country, asset_id, CAST(mm_date AS STRING) AS mm_date,
    CAST(inmo_date AS STRING) AS inmo_date, CAST(assigned_date AS STRING) AS assigned_date, cur
    FROM v_enriched""",
)
def enrich_first_events(t, current):
    df = sellers.enrich_first_events(t.leads, t.state_log, t.stage_log, AS_OF, current)
    dates = [F.col(c).cast("string").alias(c) for c in ("mm_date", "inmo_date", "assigned_date")]
    return df.select("deal_id", "country", "asset_id", *dates, F.col("state_id").alias("cur"))


@query(
    "union_all_grains",
    f"""SELECT g, country, CAST({sql_grain_start('created')} AS STRING) AS start, count(*) AS n
    FROM v_base CROSS JOIN {SQL_GRAINS} GROUP BY ALL""",
)
def union_all_grains(t):
    daily = scan_leads(t.leads, AS_OF).groupBy("country", "created").agg(F.count("*").alias("n"))
    out = rollup.explode_grains(daily, "created", ("country", "n")).groupBy("g", "country", "start")
    return out.agg(F.sum("n").alias("n")).withColumn("start", F.col("start").cast("string"))


# --- Q2 ---------------------------------------------------------------------------------
_ANTI = f"""WITH rows_ AS (
  SELECT b.country, b.source_id, b.created, c.state_id FROM v_base b
  JOIN v_current_mm c ON c.country = b.country AND c.deal_id = b.deal_id
  WHERE c.state_id NOT IN (20, 63)),
{by_grain('rows_', 'country, source_id, state_id', 'count(*) AS n')}"""


@board(
    "antifunnel",
    f"""{_ANTI} SELECT g, {sql_label()} AS c, source_id AS f, p, k.state_id,
    coalesce(cat.name, concat('state_', k.state_id)) AS state_name, n
    FROM kept k LEFT JOIN v_state_catalogue cat ON cat.state_id = k.state_id""",
)
def antifunnel(t, current):
    return sellers.antifunnel(t.leads, t.state_log, t.state_catalogue, AS_OF, current)


@board(
    "antifunnel_multi_grain",
    f"{_ANTI} SELECT g, country, source_id, p, state_id, n FROM kept",
)
def antifunnel_multi_grain(t, current):
    states = events.current_state(t.state_log, current).where(~F.col("state_id").isin(20, 63))
    base = scan_leads(t.leads, AS_OF).select("country", "deal_id", "source_id", "created")
    out = rollup.count_by_grain(
        base.join(states, ["country", "deal_id"]), ("country", "source_id", "state_id")
    )
    return out.drop("start")


# --- Q3 ---------------------------------------------------------------------------------
_MISSING = f"""WITH rows_ AS (
  SELECT b.country, b.source_id, b.created, c.state_id FROM v_base b
  JOIN v_first_mm m ON m.country = b.country AND m.deal_id = b.deal_id
  LEFT JOIN v_first_inmo i ON i.country = b.country AND i.deal_id = b.deal_id
  LEFT JOIN v_current_inmo c ON c.country = b.country AND c.deal_id = b.deal_id
  WHERE i.deal_id IS NULL),
{by_grain('rows_', 'country, source_id, state_id', 'count(*) AS n')}"""


@board(
    "mm_without_inmo",
    f"""{_MISSING} SELECT g, {sql_label()} AS c, source_id AS f, p,
    coalesce(k.state_id, -1) AS state_id, coalesce(cat.name, CASE WHEN k.state_id IS NULL
      THEN '(sin registro Inmo)' ELSE concat('state_', k.state_id) END) AS state_name, n
    FROM kept k LEFT JOIN v_state_catalogue cat ON cat.state_id = k.state_id""",
)
def mm_without_inmo(t, current):
    return sellers.mm_without_inmo(t.leads, t.state_log, t.state_catalogue, AS_OF, current)


@board(
    "missing_track_states",
    f"{_MISSING} SELECT g, country, source_id, p, state_id, n FROM kept",
)
def missing_track_states(t, current):
    rows = sellers.missing_second_track(t.leads, t.state_log, AS_OF, current)
    out = rollup.count_by_grain(rows, ("country", "source_id", "inmo_state_id"))
    return out.drop("start").withColumnRenamed("inmo_state_id", "state_id")


# --- Q12 --------------------------------------------------------------------------------
VIEWS["transitions"] = """
SELECT country, deal_id, max(CASE WHEN state_id IN (7, 39) THEN 1 ELSE 0 END) AS ever_inc,
  max(CASE WHEN state_id = 3 THEN 1 ELSE 0 END) AS ever_rev,
  min(ts) FILTER (state_id IN (7, 39)) AS first_inc, min(ts) FILTER (state_id = 3) AS first_rev,
  max(ts) FILTER (state_id = 20) AS last_20
FROM v_state_log_mm WHERE deal_id IS NOT NULL AND state_id IN (3, 7, 20, 39) GROUP BY ALL"""
_TRANS_METRICS = """count(*) AS tr, count(DISTINCT asset_id) AS t,
  count(*) FILTER (ever_inc = 1) AS inc_pass,
  count(*) FILTER (ever_inc = 1 AND (cur IS NULL OR cur NOT IN (7, 39))) AS inc_left,
  count(*) FILTER (ever_inc = 1 AND last_20 > first_inc) AS inc_to_20,
  count(*) FILTER (ever_rev = 1) AS rev_pass,
  count(*) FILTER (ever_rev = 1 AND (cur IS NULL OR cur <> 3)) AS rev_left,
  count(*) FILTER (ever_rev = 1 AND last_20 > first_rev) AS rev_to_20"""
_TRANS = f"""WITH rows_ AS (
  SELECT b.*, h.ever_inc, h.ever_rev, h.first_inc, h.first_rev, h.last_20, c.state_id AS cur
  FROM v_base b
  LEFT JOIN v_transitions h ON h.country = b.country AND h.deal_id = b.deal_id
  LEFT JOIN v_current_mm c ON c.country = b.country AND c.deal_id = b.deal_id),
{by_grain('rows_', 'country, source_id, min(source_name) AS fn', _TRANS_METRICS)}"""
_TRANS_COLS = "tr, t, inc_pass, inc_left, inc_to_20, rev_pass, rev_left, rev_to_20"


@board(
    "transitory_states",
    f"{_TRANS} SELECT g, {sql_label()} AS c, source_id AS f, fn, p, {_TRANS_COLS} FROM kept",
)
def transitory_states(t, current):
    return sellers.transitory_states(t.leads, t.state_log, AS_OF, current)


@board(
    "transition_multi_grain",
    f"""{_TRANS} SELECT g, CAST(start AS STRING) AS start, {sql_label()} AS c, source_id AS f, fn, p,
    {_TRANS_COLS} FROM kept""",
)
def transition_multi_grain(t, current):
    out = sellers.transition_multi_grain(t.leads, t.state_log, AS_OF, current)
    return out.withColumn("start", F.col("start").cast("string"))


def _rate(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN 100.0::DOUBLE * {num}::DOUBLE / {den}::DOUBLE ELSE 0.0::DOUBLE END"


_RATES = {
    f"{s}_{name}": _rate(f"{s}_{num}", den.format(s=s))
    for s in ("inc", "rev")
    for name, num, den in (
        ("pass_rate", "pass", "tr"),
        ("left_rate", "left", "{s}_pass"),
        ("rescue_of_pass", "to_20", "{s}_pass"),
        ("rescue_of_left", "to_20", "{s}_left"),
    )
}
_SCALED = [n for n in _RATES if not n.endswith("of_left")]
_PAGE = f"""{_TRANS}, page AS (
  SELECT g, {sql_label()} AS c, start, p, CAST(sum(tr) AS BIGINT) AS tr,
  {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in _TRANS_COLS.split(', ')[2:])}
  FROM kept GROUP BY ALL),
shown AS (SELECT * FROM page
  QUALIFY g = 'Y' OR row_number() OVER (PARTITION BY g, c ORDER BY start DESC) <= 20),
rates AS (SELECT g, c, start, p, {', '.join(f'{e} AS {n}' for n, e in _RATES.items())} FROM shown)"""


def _minmax(n: str) -> str:
    lo, hi = f"min({n}) OVER (PARTITION BY g, c)", f"max({n}) OVER (PARTITION BY g, c)"
    return f"({n} - {lo}) / (CASE WHEN {hi} - {lo} = 0 THEN 1.0::DOUBLE ELSE {hi} - {lo} END) AS {n}_scaled"


@query(
    "minmax_scaled_rate",
    f"""{_PAGE} SELECT g, c, p, {', '.join(_RATES)}, {', '.join(_minmax(n) for n in _SCALED)},
    start = {sql_grain_start(D)} AS open_period FROM rates""",
)
def minmax_scaled_rate(t):
    board = sellers.transition_multi_grain(t.leads, t.state_log, AS_OF)
    return sellers.transitory_rates(board, AS_OF)


@query(
    "transition_summary",
    """SELECT country, deal_id, ever_inc, ever_rev, CAST(first_inc AS STRING) AS first_inc,
    CAST(first_rev AS STRING) AS first_rev, CAST(last_20 AS STRING) AS last_20 FROM v_transitions""",
)
def transition_summary(t):
    out = events.transition_summary(t.state_log)
    return out.select(
        "country",
        "deal_id",
        "ever_inc",
        "ever_rev",
        *[F.col(c).cast("string").alias(c) for c in ("first_inc", "first_rev", "last_20")],
    )


@query(
    "rescued_after",
    """SELECT country, deal_id, coalesce(last_20 > first_inc, false) AS inc_rescued,
    coalesce(last_20 > first_rev, false) AS rev_rescued FROM v_transitions""",
)
def rescued_after(t):
    s = events.transition_summary(t.state_log)
    return s.select(
        "country",
        "deal_id",
        events.rescued_after(F.col("first_inc"), F.col("last_20")).alias("inc_rescued"),
        events.rescued_after(F.col("first_rev"), F.col("last_20")).alias("rev_rescued"),
    )
