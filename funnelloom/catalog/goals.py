"""Target sheet, weekly targets, target tracking."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from funnelloom.catalog.registry import VIEWS, query, sql_bucket
from funnelloom.functions import dates, ratios, text
from funnelloom.operators import targets
from funnelloom.operators.scans import scan_leads
from funnelloom.plans import okr, weekly
from funnelloom.session import scratch_path
from funnelloom.sources import target_sheet
from funnelloom.sources.testdata import AS_OF
from funnelloom.spec import COUNTRIES

D = f"DATE '{AS_OF}'"
YEAR = AS_OF.year
SPEND_START = dt.date(YEAR - 1, 1, 1)
_OFFICIAL = """((country = 'CO' AND source_id IN (3,7,20,35,39,47))
  OR (country = 'MX' AND source_id IN (3,7,35,39,46,47)))"""
_SOURCE = """CASE source_id WHEN 3 THEN 'WEB' WHEN 7 THEN 'Estudio Inmueble' WHEN 20 THEN 'CRM'
  WHEN 35 THEN 'Comercial' WHEN 39 THEN 'Broker' WHEN 46 THEN 'Propiedades' WHEN 47 THEN 'lead_forms' END"""


def _text(df, *names):
    return df.withColumns({n: F.col(n).cast("string") for n in names})


def _entries() -> str:
    arms = []
    for g in "YQMWC":
        moved = "d + 364" if g in "WC" else "CAST(d + INTERVAL 1 YEAR AS DATE)"
        arms.append(f"SELECT country, block, '{g}' AS g, {sql_bucket('d', g)} AS start, 1 AS now, 0 AS prev FROM e")
        arms.append(f"SELECT country, block, '{g}', {sql_bucket(f'({moved})', g)}, 0, 1 FROM e")
    return " UNION ALL ".join(arms)


VIEWS["sheet_counts"] = f"""
WITH b AS (SELECT country, CAST(created_at AS DATE) AS d, {_SOURCE} AS s FROM v_leads
  WHERE {_OFFICIAL} AND created_at >= DATE '{SPEND_START}' AND created_at < {D}),
e AS (SELECT country, d, s AS block FROM b UNION ALL SELECT country, d, 'TOTAL' FROM b
  UNION ALL SELECT country, d, 'Perfo' FROM b WHERE s IN ('WEB', 'lead_forms', 'Estudio Inmueble')),
x AS ({_entries()})
SELECT country, g, start, block, CAST(sum(now) AS BIGINT) AS now, CAST(sum(prev) AS BIGINT) AS prev
FROM x WHERE start >= DATE '{YEAR}-01-01' AND start < {D} GROUP BY ALL"""
_MONTHS = ", ".join(f"'{m}'" for m in targets.MONTH_NAMES)
VIEWS["targets"] = f"""
WITH p AS (SELECT DISTINCT country, g, start FROM v_sheet_counts),
k AS (SELECT p.*, s.source FROM p JOIN (
  SELECT 'CO' AS country, unnest(['TOTAL','Perfo','WEB','lead_forms','Estudio Inmueble','CRM','Broker','Comercial']) AS source
  UNION ALL SELECT 'MX', unnest(['TOTAL','Perfo','WEB','lead_forms','Estudio Inmueble','Propiedades','Broker','Comercial']))
  s USING (country))
SELECT k.country, CASE k.g WHEN 'Y' THEN 'annual' WHEN 'Q' THEN 'quarterly' WHEN 'M' THEN 'monthly'
    WHEN 'W' THEN 'weekly' ELSE 'cycles' END AS section,
  CASE k.g WHEN 'Q' THEN concat('Q', quarter(k.start)) WHEN 'M' THEN ([{_MONTHS}])[month(k.start)]
    ELSE CAST(year(k.start) AS STRING) END AS period, k.start AS "from",
  CASE k.g WHEN 'Y' THEN CAST(k.start + INTERVAL 1 YEAR AS DATE) - 1
    WHEN 'Q' THEN CAST(k.start + INTERVAL 3 MONTH AS DATE) - 1
    WHEN 'M' THEN CAST(k.start + INTERVAL 1 MONTH AS DATE) - 1 ELSE k.start + 6 END AS "to",
  k.source, 1100 * now + 7 AS meta, CASE WHEN k.source <> 'Broker' THEN 950 * now + 3 END AS mtd,
  CASE WHEN now <> 0 THEN 1000 * now END AS actual, CASE WHEN prev <> 0 THEN 1000 * prev END AS prev
FROM k LEFT JOIN v_sheet_counts c ON c.country = k.country AND c.g = k.g AND c.start = k.start
  AND c.block = k.source"""
_TARGET_COLS = """country, section, period, CAST("from" AS STRING) AS "from", CAST("to" AS STRING) AS "to",
  source, meta, mtd, actual, prev"""
VIEWS["targets_less"] = """
SELECT t.country, t.section, t.period, t."from", t."to", t.source,
  CASE WHEN x.source IS NULL THEN t.meta ELSE t.meta - ifnull(x.meta, 0) END AS meta,
  CASE WHEN x.source IS NULL THEN t.mtd ELSE t.mtd - ifnull(x.mtd, 0) END AS mtd,
  CASE WHEN x.source IS NULL THEN t.actual ELSE t.actual - ifnull(x.actual, 0) END AS actual,
  CASE WHEN x.source IS NULL THEN t.prev ELSE t.prev - ifnull(x.prev, 0) END AS prev
FROM v_targets t LEFT JOIN v_targets x ON x.country = 'MX' AND x.source = 'Propiedades' AND t.source = 'TOTAL'
  AND t.country = x.country AND t.section = x.section AND t."from" = x."from"
WHERE NOT (t.country = 'MX' AND t.source = 'Propiedades')"""


def _shown(df):
    return _text(df.drop("row_no"), "from", "to")


def _targets(t):
    return targets.targets_from_sheet(t.target_sheet)


@query("targets_from_sheet", f"SELECT {_TARGET_COLS} FROM v_targets")
def targets_from_sheet(t):
    return _shown(_targets(t))


@query("targets_from_csv", f"SELECT {_TARGET_COLS} FROM v_targets")
def targets_from_csv(t):
    """The same sheets by way of one exported file per country."""
    folder, sheet, read = scratch_path(t.spark, "sheets"), t.target_sheet, None
    for spec in COUNTRIES:
        path = f"{folder}/{spec.code}"
        target_sheet.write_sheet_csv(sheet.where(F.col("country") == spec.code), path)
        one = target_sheet.read_sheet_csv(t.spark, path, spec.code)
        read = one if read is None else read.unionByName(one)
    return _shown(targets.targets_from_sheet(read))


@query("subtract_source_total", f"SELECT {_TARGET_COLS} FROM v_targets_less")
def subtract_source_total(t):
    return _shown(targets.subtract_source_total(_targets(t), "MX", "Propiedades"))


@query(
    "keep_monday_weeks",
    """SELECT DISTINCT country, section, CAST("from" AS STRING) AS "from" FROM v_targets
    WHERE section IN ('weekly', 'cycles') AND isodow("from") = 1""",
)
def keep_monday_weeks(t):
    rows = targets.sheet_rows(t.target_sheet).where(F.col("section").isin("weekly", "cycles"))
    out = targets.keep_monday_weeks(rows, "from")
    return _text(out.select("country", "section", "from"), "from")


# --- text parsing ------------------------------------------------------------------------
def _parse(bare: str) -> str:
    return f"""CASE WHEN trim(number_text) IN ('', '#N/A', '-', '#REF!', '#VALUE!') THEN NULL
      ELSE TRY_CAST({bare} AS BIGINT) END"""


_BARE = "replace(regexp_replace(trim(number_text), '%$', ''), '.', '')"


@query(
    "parse_latam_number",
    f"""SELECT row_no, {_parse(f"CASE WHEN {_BARE} NOT LIKE '%,%' THEN {_BARE} END")} AS strict,
    {_parse(f"replace({_BARE}, ',', '')")} AS lenient FROM v_sheet_text""",
)
def parse_latam_number(t):
    number = F.col("number_text")
    return t.sheet_text.select(
        "row_no",
        text.parse_latam_number(number).alias("strict"),
        text.parse_latam_number(number, strip_commas=True).alias("lenient"),
    )


@query(
    "parse_dmy_date",
    "SELECT row_no, CAST(CAST(try_strptime(date_text, '%d/%m/%Y') AS DATE) AS STRING) AS d FROM v_sheet_text",
)
def parse_dmy_date(t):
    day = text.parse_dmy_date(F.col("date_text")).cast("string").alias("d")
    return t.sheet_text.select("row_no", day)


def _moved(day: str, year: int) -> str:
    return f"TRY_CAST(concat('{year}-', lpad(CAST(month({day}) AS STRING), 2, '0'), '-', lpad(CAST(day({day}) AS STRING), 2, '0')) AS DATE)"


def _prior(year: int) -> tuple[str, str]:
    ok = f"{_moved('first_day', year)} IS NOT NULL AND {_moved('last_day', year)} IS NOT NULL"
    return tuple(
        f"CASE WHEN year(first_day) = {year} THEN {c} WHEN {ok} THEN {_moved(c, year)} END"
        for c in ("first_day", "last_day")
    )


@query(
    "prior_year_range",
    f"""SELECT row_no, CAST({_prior(1999)[0]} AS STRING) AS "from", CAST({_prior(1999)[1]} AS STRING) AS "to"
    FROM v_sheet_text""",
)
def prior_year_range(t):
    first, last = dates.prior_year_range(F.col("first_day"), F.col("last_day"), 1999)
    return t.sheet_text.select(
        "row_no", first.cast("string").alias("from"), last.cast("string").alias("to")
    )


@query(
    "cap_to_yesterday",
    """SELECT row_no, CASE WHEN first_day <= DATE '2000-05-31' THEN CAST(first_day AS STRING) END AS "from",
    CASE WHEN first_day <= DATE '2000-05-31' THEN CAST(least(last_day, DATE '2000-05-31') AS STRING) END AS "to"
    FROM v_sheet_text""",
)
def cap_to_yesterday(t):
    first, last = dates.cap_to_yesterday(F.col("first_day"), F.col("last_day"), dt.date(2000, 6, 1))
    return t.sheet_text.select(
        "row_no", first.cast("string").alias("from"), last.cast("string").alias("to")
    )


# --- spend in ranges ------------------------------------------------------------------------
VIEWS["spend_day"] = f"""
SELECT country, CAST(date AS DATE) AS day, CAST(round(sum(spend), 0) AS BIGINT) AS spend FROM v_spend
WHERE date >= DATE '{SPEND_START}' AND date < {D} GROUP BY ALL"""


def _spend_day(t):
    return targets.daily_spend(t.spend, SPEND_START, AS_OF)


@query(
    "range_sum_spend",
    """WITH r AS (SELECT DISTINCT country, section, "from", "to" FROM v_targets)
    SELECT r.country, section, CAST("from" AS STRING) AS "from", CAST("to" AS STRING) AS "to",
      CAST(coalesce(sum(spend), 0) AS BIGINT) AS spend
    FROM r LEFT JOIN v_spend_day d ON d.country = r.country AND d.day BETWEEN r."from" AND r."to" GROUP BY ALL""",
)
def range_sum_spend(t):
    rows = targets.sheet_rows(t.target_sheet).select("country", "section", "from", "to")
    keyed = rows.withColumns({"f": F.col("from").cast("string"), "l": F.col("to").cast("string")})
    out = targets.range_sum_spend(keyed, _spend_day(t), ["section", "f", "l"])
    return out.withColumnsRenamed({"f": "from", "l": "to"})


_YEST = f"DATE '{AS_OF - dt.timedelta(days=1)}'"


def _year_moved(c: str, year: int) -> str:
    return f"CASE WHEN year(\"from\") = {year} THEN {c} ELSE {_moved(c, year)} END"


_SPAN = "coalesce((SELECT sum(spend) FROM v_spend_day d WHERE d.country = r.country AND d.day BETWEEN r.{0} AND r.{1}), 0)"
VIEWS["okr"] = f"""
WITH p AS (
  SELECT * FROM v_targets_less WHERE source = 'TOTAL'
    AND (section = 'annual' OR ifnull(actual, 0) <> 0
      OR (section IN ('quarterly', 'monthly') AND ifnull(mtd, 0) <> 0))),
r AS (SELECT p.*, CASE section WHEN 'annual' THEN '{YEAR}' WHEN 'quarterly' THEN period
    WHEN 'monthly' THEN (['Ene','Feb','Mar','Abr','May','Jun','Jul','Ago','Sep','Oct','Nov','Dic'])[month("from")]
    ELSE strftime("from", '%d/%m') || ' - ' || strftime("to", '%d/%m') END AS label,
  "from" AS now_from, least("to", {_YEST}) AS now_to,
  CASE WHEN section IN ('weekly', 'cycles') THEN {_moved('"from"', YEAR - 1)}
    ELSE CAST("from" - INTERVAL 1 YEAR AS DATE) END AS prev_from,
  CASE WHEN section IN ('weekly', 'cycles') THEN {_moved('"to"', YEAR - 1)}
    ELSE CAST(least("to", {_YEST}) - INTERVAL 1 YEAR AS DATE) END AS prev_to FROM p)
SELECT country, section, label, meta AS target, mtd AS to_date, actual, prev,
  CAST({_SPAN.format('now_from', 'now_to')} AS BIGINT) AS spend,
  CAST({_SPAN.format('prev_from', 'prev_to')} AS BIGINT) AS spend_prev FROM r"""


def _half_up(x: str) -> str:
    return f"CAST(floor({x} + 0.5::DOUBLE) AS BIGINT)"


def _yoy(a: str, b: str) -> str:
    return f"CASE WHEN {a} IS NOT NULL AND {b} <> 0 THEN {_half_up(f'({a}::DOUBLE - {b}::DOUBLE) / {b}::DOUBLE * 100.0::DOUBLE')} END"


_TRACKER = f"""WITH z AS (SELECT *, ifnull(actual, 0) AS la, ifnull(to_date, 0) AS lm, ifnull(prev, 0) AS lp FROM v_okr),
y AS (SELECT *, CASE WHEN lm <> 0 THEN {_half_up('la::DOUBLE / lm::DOUBLE * 100.0::DOUBLE')} END AS attainment,
  CASE WHEN la <> 0 THEN {_half_up('spend::DOUBLE / la::DOUBLE')} END AS cpla,
  CASE WHEN lp <> 0 THEN {_half_up('spend_prev::DOUBLE / lp::DOUBLE')} END AS cpla_prev FROM z)
SELECT country, section, label, target, to_date, actual, prev, spend, spend_prev, attainment,
  CASE WHEN attainment >= 95 THEN 'good' WHEN attainment >= 80 THEN 'warn'
    WHEN attainment IS NOT NULL THEN 'bad' END AS band,
  {_yoy('la', 'lp')} AS leads_yoy, {_yoy('spend', 'spend_prev')} AS spend_yoy, cpla, cpla_prev,
  {_yoy('cpla', 'cpla_prev')} AS cpla_yoy FROM y"""


def _okr(t):
    less = targets.subtract_source_total(_targets(t), "MX", "Propiedades")
    return okr.okr_rows(less, _spend_day(t), AS_OF)


@query("okr_tracker", _TRACKER)
def okr_tracker(t):
    return okr.okr_tracker(_okr(t))


@query(
    "yoy_pct",
    f"SELECT country, section, label, {_yoy('spend', 'spend_prev')} AS spend_yoy FROM v_okr",
)
def yoy_pct(t):
    change = ratios.yoy_pct(F.col("spend"), F.col("spend_prev")).alias("spend_yoy")
    return _okr(t).select("country", "section", "label", change)


@query(
    "attainment_band",
    """SELECT country, section, "from"::STRING AS "from", source, CASE WHEN mtd > 0 THEN
      CASE WHEN 100.0::DOUBLE * actual::DOUBLE / mtd::DOUBLE >= 95 THEN 'good'
      WHEN 100.0::DOUBLE * actual::DOUBLE / mtd::DOUBLE >= 80 THEN 'warn'
      WHEN actual IS NOT NULL THEN 'bad' END END AS band FROM v_targets""",
)
def attainment_band(t):
    band = ratios.attainment_band(ratios.pct(F.col("actual"), F.col("mtd"))).alias("band")
    return _text(_targets(t), "from").select("country", "section", "from", "source", band)


# --- weekly results with targets ---------------------------------------------------------------
VIEWS["week_goal"] = """
SELECT country, CAST("from" AS STRING) AS week_start, source, meta FROM v_targets WHERE section = 'weekly'"""


def _weekly(t):
    return weekly.weekly_by_source(t.leads, t.state_log_mm, t.assigned_mart, t.spend, AS_OF)


_GRID = """WITH w AS (SELECT DISTINCT country, week_start FROM v_by_source),
k AS (SELECT w.*, s.source, s.shown FROM w JOIN (
  SELECT 'CO' AS country, unnest(['WEB','lead_forms','Estudio Inmueble','CRM','Broker','Comercial']) AS source, TRUE AS shown
  UNION ALL SELECT 'MX', unnest(['WEB','lead_forms','Estudio Inmueble','Propiedades','Broker','Comercial']), TRUE
  UNION ALL SELECT c, unnest(['TOTAL','Perfo']), FALSE FROM (VALUES ('CO'), ('MX')) c(c)) s USING (country))
SELECT k.country, k.week_start, k.source, CASE WHEN shown THEN ifnull(reg, 0) END AS reg,
  CASE WHEN shown THEN ifnull(cal, 0) END AS cal, CASE WHEN shown THEN ifnull(asg, 0) END AS asg,
  CAST(spend AS BIGINT) AS spend, meta
FROM k LEFT JOIN v_by_source b ON b.country = k.country AND b.week_start = k.week_start AND b.source = k.source
LEFT JOIN v_week_goal g ON g.country = k.country AND g.week_start = k.week_start AND g.source = k.source"""


@query("weekly_with_targets", _GRID)
def weekly_with_targets(t):
    return okr.weekly_with_targets(_weekly(t), t.target_sheet)


@query(
    "join_targets_by_week",
    """SELECT b.country, b.week_start, b.source, reg, meta FROM v_by_source b
    LEFT JOIN v_week_goal g ON g.country = b.country AND g.week_start = b.week_start AND g.source = b.source""",
)
def join_targets_by_week(t):
    goals = targets.weekly_targets(t.target_sheet)
    goals = goals.select("country", F.col("week").cast("string").alias("week_start"), "source", "meta")
    rows = _weekly(t).select("country", "week_start", "source", "reg")
    return rows.join(goals, ["country", "week_start", "source"], "left")


@query(
    "safe_ratio",
    """SELECT country, week_start, source, CASE WHEN reg > 0 THEN cal::DOUBLE / reg::DOUBLE END AS cvr,
    CASE WHEN asg > 0 THEN spend / asg::DOUBLE END AS cost FROM v_by_source""",
)
def safe_ratio(t):
    return _weekly(t).select(
        "country",
        "week_start",
        "source",
        ratios.safe_ratio(F.col("cal"), F.col("reg")).alias("cvr"),
        ratios.safe_ratio(F.col("spend"), F.col("asg")).alias("cost"),
    )


@query(
    "exclude_open_period",
    f"""SELECT country, CAST({sql_bucket('created_at', 'M')} AS STRING) AS month, count(*) AS n FROM v_leads
    WHERE created_at < DATE '2001-07-15' AND {_OFFICIAL}
    GROUP BY country, {sql_bucket('created_at', 'M')} HAVING {sql_bucket('created_at', 'M')} < DATE '2001-07-01'""",
)
def exclude_open_period(t):
    day = dt.date(2001, 7, 15)
    month = F.trunc("created", "MONTH").alias("month")
    rows = scan_leads(t.leads, day).groupBy("country", month).agg(F.count("*").alias("n"))
    return _text(dates.exclude_open_period(rows, "month", day, "M"), "month")
