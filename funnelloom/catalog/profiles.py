"""Incomplete leads."""

from __future__ import annotations

from pyspark.sql import functions as F

from funnelloom.catalog.registry import VIEWS, query, sql_bucket, sql_grain_label
from funnelloom.plans import incomplete
from funnelloom.spec import (
    COMPLETENESS_ATTRS,
    PROPERTY_TYPES,
    RECOVERY_AGENTS,
)

_LATE = "completed_at > created_at + INTERVAL 1 HOUR"
_NOW = "incomplete_at IS NOT NULL AND completed_at IS NULL"
_TYPE = """CASE WHEN type IS NULL THEN 'none' WHEN type BETWEEN 1 AND 5 THEN CAST(type AS STRING) ELSE 'other' END"""
_AGENT = """CASE WHEN agent IN ('callcenter','bot','whatsapp','duplicates','pricing','docking','staff')
  THEN agent ELSE 'others' END"""
_COLS = {
    "total": "TRUE",
    "incomplete": _NOW,
    "incomplete_60m": f"incomplete_at IS NOT NULL AND (completed_at IS NULL OR {_LATE})",
    "recovered": f"incomplete_at IS NOT NULL AND {_LATE}",
}
_COLS |= {f"no_{a}": f"{a} IS NULL" for a in incomplete.ATTRS}
_COLS |= {f"ag_{a}": f"incomplete_at IS NOT NULL AND {_LATE} AND {_AGENT} = '{a}'" for a in RECOVERY_AGENTS}
_COLS |= {f"tp_{k}": f"{_TYPE} = '{k}'" for k in PROPERTY_TYPES}
_COLS |= {f"ip_{k}": f"{_TYPE} = '{k}' AND {_NOW}" for k in PROPERTY_TYPES}
_COUNTS = ", ".join(f"count(*) FILTER ({test}) AS {n}" for n, test in _COLS.items())
VIEWS["profile"] = " UNION ALL ".join(
    f"""SELECT '{g}' AS g, {sql_bucket('created_at', g)} AS start, source_id, {_COUNTS} FROM v_profiles
    GROUP BY {sql_bucket('created_at', g)}, source_id"""
    for g in "DWM"
)
VIEWS["page"] = f"""
SELECT * FROM (SELECT g, start, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in _COLS)}
  FROM v_profile GROUP BY g, start)
QUALIFY row_number() OVER (PARTITION BY g ORDER BY start DESC) <= 20"""


def _start(df):
    return df.withColumn("start", F.col("start").cast("string"))


def _page(t):
    return incomplete.page_rows(incomplete.incomplete_profile(t.profiles))


def _pct(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN 100.0::DOUBLE * {a}::DOUBLE / {b}::DOUBLE ELSE 0.0::DOUBLE END"


@query("incomplete_profile", "SELECT * REPLACE (CAST(start AS STRING) AS start) FROM v_profile")
def incomplete_profile(t):
    return _start(incomplete.incomplete_profile(t.profiles))


@query(
    "incomplete_leads",
    f"""SELECT g, CAST(start AS STRING) AS start, {sql_grain_label('start')} AS p, total, incomplete,
    incomplete_60m, recovered, {_pct('incomplete', 'total')} AS pct_incomplete,
    {_pct('incomplete_60m', 'total')} AS pct_60m, {_pct('recovered', 'incomplete_60m')} AS pct_recovered
    FROM v_page""",
)
def incomplete_leads(t):
    return _start(incomplete.incomplete_rates(_page(t)))


def _banded(prefix: str, names, name: str, base: str, extra: str = "") -> str:
    rows = " UNION ALL ".join(
        f"SELECT g, start, {base} AS base, '{n}' AS {name}, {prefix}_{n} AS n FROM v_page" for n in names
    )
    top = f"max(rate) OVER (PARTITION BY g, {name})"
    return f"""WITH x AS (SELECT *, {_pct('n', 'base')} AS rate{extra} FROM ({rows})),
    y AS (SELECT *, CASE WHEN {top} > 0 THEN rate / {top} ELSE 0.0::DOUBLE END AS of_max FROM x
      {'WHERE agent_total > 0' if extra else ''})
    SELECT * REPLACE (CAST(start AS STRING) AS start), CASE WHEN of_max > 0.8 THEN 'high'
      WHEN of_max > 0.5 THEN 'mid' ELSE 'low' END AS band FROM y"""


@query("rate_vs_row_max", _banded("no", incomplete.ATTRS, "attribute", "total"))
def rate_vs_row_max(t):
    return _start(incomplete.missing_attributes(_page(t)))


@query(
    "recovery_by_agent",
    _banded(
        "ag", RECOVERY_AGENTS, "agent", "recovered",
        ", CAST(sum(n) OVER (PARTITION BY g, agent) AS BIGINT) AS agent_total",
    ),
)
def recovery_by_agent(t):
    return _start(incomplete.recovery_by_agent(_page(t)))


@query(
    "type_by_incomplete",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"""SELECT g, '{k}' AS type, CAST(sum(tp_{k}) AS BIGINT) AS total,
        CAST(sum(ip_{k}) AS BIGINT) AS incomplete FROM v_page GROUP BY g"""
        for k in PROPERTY_TYPES
    )
    + ") WHERE total > 0 OR incomplete > 0",
)
def type_by_incomplete(t):
    return incomplete.type_by_incomplete(_page(t))


@query(
    "pp_change_latest",
    f"""WITH r AS (SELECT g, start, round(CAST({_pct('incomplete', 'total')} AS DECIMAL(20,10)), 1) AS share FROM v_page),
    l AS (SELECT *, coalesce(lag(share) OVER (PARTITION BY g ORDER BY start), share) AS prev FROM r)
    SELECT g, CAST(start AS STRING) AS start, CAST(share AS DOUBLE) AS share, CAST(prev AS DOUBLE) AS prev,
      CAST(share - prev AS DOUBLE) AS change
    FROM l QUALIFY row_number() OVER (PARTITION BY g ORDER BY l.start DESC) = 1""",
)
def pp_change_latest(t):
    out = incomplete.change_in_share(_page(t))
    return _start(out).withColumns({c: F.col(c).cast("double") for c in ("share", "prev", "change")})


@query(
    "top_missing_attribute",
    f"""WITH x AS ({' UNION ALL '.join(
        f"SELECT g, start, incomplete, {i} AS pos, '{a}' AS attribute, no_{a} AS n FROM v_page"
        for i, a in enumerate(COMPLETENESS_ATTRS))})
    SELECT g, CAST(start AS STRING) AS start, incomplete, attribute, n FROM x
    QUALIFY row_number() OVER (PARTITION BY g ORDER BY x.start DESC, n DESC, pos) = 1""",
)
def top_missing_attribute(t):
    return _start(incomplete.top_missing_attribute(_page(t)))
