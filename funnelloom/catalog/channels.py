"""Channel attribution, daily review and weekly review."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from funnelloom.catalog.registry import VIEWS, query, sql_bucket
from funnelloom.functions import text
from funnelloom.functions.dates import iso_week_start, lookback_start
from funnelloom.operators import channels, events, joins
from funnelloom.operators.scans import scan_leads, scan_spend
from funnelloom.plans import dupont, weekly
from funnelloom.sources.testdata import AS_OF

D = f"DATE '{AS_OF}'"
D180 = f"DATE '{AS_OF - dt.timedelta(days=180)}'"
W = weekly.WeekWindow.ending(AS_OF)
FIRST, END, FIRST_CAL, YEAR = (f"DATE '{d}'" for d in (W.first, W.end, W.first_cal, W.year_back))

for _key, _name in (("campaign_original", "dict_lead"), ("campaign_name", "dict_spend")):
    VIEWS[_name] = f"""
SELECT {_key} AS campaign, channel_medium, platform FROM v_dictionary
QUALIFY row_number() OVER (PARTITION BY {_key} ORDER BY row_no) = 1"""

_CHANNEL = """CASE WHEN source_name IN ('lead_forms', 'Lead Forms') THEN 'lead_forms'
  WHEN l.campaign IS NULL OR l.campaign = '' THEN source_name || ' Direct'
  WHEN channel_medium IS NULL OR channel_medium = '' THEN l.campaign ELSE channel_medium END"""
_TRACKED = """CASE WHEN source_name IN ('lead_forms', 'Lead Forms') THEN 'lead_forms'
  WHEN channel_medium IS NULL OR channel_medium = '' THEN l.campaign ELSE channel_medium END"""
_SOURCE = """CASE source_id WHEN 3 THEN 'WEB' WHEN 7 THEN 'Estudio Inmueble' WHEN 20 THEN 'CRM'
  WHEN 35 THEN 'Comercial' WHEN 39 THEN 'Broker' WHEN 46 THEN 'Propiedades' WHEN 47 THEN 'lead_forms' END"""
_OFFICIAL = """((country = 'CO' AND source_id IN (3,7,20,35,39,47))
  OR (country = 'MX' AND source_id IN (3,7,35,39,46,47)))"""
_COLLAPSED = """CASE WHEN channel_medium IN ('lead_forms Paid', 'lead_forms Direct')
  OR (country = 'MX' AND channel_medium = 'Lead Forms Paid') THEN 'lead_forms' ELSE channel_medium END"""
_MEDIUM_SOURCE = """CASE WHEN channel_medium LIKE 'WEB%' THEN 'WEB'
  WHEN channel_medium LIKE 'Estudio Inmueble%' THEN 'Estudio Inmueble'
  WHEN channel_medium IN ('lead_forms Paid', 'lead_forms Direct')
    OR channel_medium LIKE 'Lead Forms%' THEN 'lead_forms'
  WHEN country = 'MX' AND channel_medium LIKE 'Propiedades%' THEN 'Propiedades' END"""

VIEWS["lead_channel"] = f"""
SELECT l.*, {_CHANNEL} AS channel, {_SOURCE} AS source
FROM v_leads l LEFT JOIN v_dict_lead d ON l.campaign = d.campaign WHERE {_OFFICIAL}"""
VIEWS["lead_platform"] = f"""
SELECT l.*, {_TRACKED} AS channel, {_SOURCE} AS source, platform
FROM v_leads l JOIN v_dict_lead d ON l.campaign = d.campaign
WHERE {_OFFICIAL} AND platform IS NOT NULL AND platform <> ''"""
VIEWS["paid"] = f"""
SELECT s.*, {_COLLAPSED} AS channel, {_MEDIUM_SOURCE} AS source, platform
FROM v_spend s JOIN v_dict_spend d ON s.campaign = d.campaign WHERE channel_medium IS NOT NULL"""

# --- Q14 ------------------------------------------------------------------------------
VIEWS["daily_leads"] = f"""
SELECT country, CAST(created_at AS DATE) AS dia, channel, count(*) AS reg, count(m.deal_id) AS cal
FROM v_lead_channel l LEFT JOIN v_first_mm m USING (country, deal_id)
WHERE created_at >= {D180} AND created_at < {D} GROUP BY ALL"""
VIEWS["daily_spend"] = f"""
SELECT country, CAST(date AS DATE) AS dia, channel, CAST(round(sum(spend), 0) AS BIGINT) AS spend
FROM v_paid WHERE date >= {D180} AND date < {D} GROUP BY ALL"""
VIEWS["dupont"] = """
SELECT coalesce(l.country, s.country) AS country, coalesce(l.dia, s.dia) AS dia,
  coalesce(l.channel, s.channel) AS channel, coalesce(reg, 0) AS reg, coalesce(cal, 0) AS cal, spend
FROM v_daily_leads l FULL OUTER JOIN v_daily_spend s
ON l.country = s.country AND l.dia = s.dia AND l.channel = s.channel"""


def _daily(t):
    return dupont.dupont_daily(t.leads, t.state_log_mm, t.dictionary, t.spend, AS_OF)


_DUPONT_SQL = "SELECT country, CAST(dia AS STRING) AS dia, channel, reg, cal, spend FROM v_dupont"


@query("dupont_daily", _DUPONT_SQL)
def dupont_daily(t):
    return _daily(t).withColumn("dia", F.col("dia").cast("string"))


@query("merge_leads_spend", _DUPONT_SQL)
def merge_leads_spend(t):
    counts = dupont.leads_by_channel(t.leads, t.state_log_mm, t.dictionary, AS_OF)
    paid = channels.spend_by_channel(
        scan_spend(t.spend, lookback_start(AS_OF, 180), AS_OF), t.dictionary, F.col("day"), "dia"
    )
    out = channels.merge_leads_spend(counts, paid, ["country", "dia", "channel"])
    return out.withColumn("dia", F.col("dia").cast("string"))


# --- Q15 ------------------------------------------------------------------------------
VIEWS["pop"] = """
SELECT d.country, n, channel,
  CAST(coalesce(sum(reg) FILTER (age < n), 0) AS BIGINT) AS reg_now,
  CAST(coalesce(sum(reg) FILTER (age >= n), 0) AS BIGINT) AS reg_prev,
  CAST(coalesce(sum(cal) FILTER (age < n), 0) AS BIGINT) AS cal_now,
  CAST(coalesce(sum(cal) FILTER (age >= n), 0) AS BIGINT) AS cal_prev,
  CAST(sum(spend) FILTER (age < n) AS BIGINT) AS spend_now,
  CAST(sum(spend) FILTER (age >= n) AS BIGINT) AS spend_prev
FROM (SELECT *, date_diff('day', dia, max(dia) OVER (PARTITION BY country)) AS age FROM v_dupont) d
CROSS JOIN (VALUES (7), (14), (28), (56)) w(n) WHERE age < 2 * n GROUP BY ALL"""
_POP_COLS = "reg_now, reg_prev, cal_now, cal_prev, spend_now, spend_prev"
VIEWS["pop_totals"] = f"""
SELECT country, n, 'channel' AS level, channel, {_POP_COLS} FROM v_pop
UNION ALL SELECT country, n, 'TOTAL', NULL,
  {', '.join(f'CAST(sum({c}) AS BIGINT)' for c in _POP_COLS.split(', '))} FROM v_pop GROUP BY ALL
UNION ALL SELECT country, n, 'TOTAL Performance', NULL,
  {', '.join(f'CAST(sum({c}) AS BIGINT)' for c in _POP_COLS.split(', '))} FROM v_pop
  WHERE spend_now IS NOT NULL OR spend_prev IS NOT NULL GROUP BY ALL"""


@query("period_over_period", f"SELECT country, n, channel, {_POP_COLS} FROM v_pop")
def period_over_period(t):
    return dupont.period_over_period(_daily(t))


@query("two_level_totals", f"SELECT country, n, level, channel, {_POP_COLS} FROM v_pop_totals")
def two_level_totals(t):
    return dupont.two_level_totals(dupont.period_over_period(_daily(t)))


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN {a}::DOUBLE / {b}::DOUBLE END"


def _cells(s: str) -> list[str]:
    return [
        f"spend_{s}::DOUBLE",
        _ratio(f"spend_{s}", f"reg_{s}"),
        f"reg_{s}::DOUBLE",
        _ratio(f"cal_{s}", f"reg_{s}"),
        f"cal_{s}::DOUBLE",
        _ratio(f"cal_{s}", f"total_{s}"),
    ]


_MATRIX = """WITH t AS (
  SELECT p.*, g.cal_now AS total_now, g.cal_prev AS total_prev FROM v_pop_totals p
  JOIN v_pop_totals g ON g.level = 'TOTAL' AND g.country = p.country AND g.n = p.n),
long AS (""" + " UNION ALL ".join(
    f"SELECT country, n, level, channel, '{key}' AS indicator, '{way}' AS way, {a} AS now, {b} AS prev FROM t"
    for (key, way), a, b in zip(dupont.INDICATORS, _cells("now"), _cells("prev"))
) + """),
d AS (SELECT *, prev = 0 AND now <> 0 AS fresh,
  CASE WHEN prev <> 0 AND now IS NOT NULL THEN (now - prev) / prev END AS delta FROM long)
SELECT country, n, level, channel, indicator, now, prev, delta, coalesce(fresh, false) AS is_new,
  CASE WHEN way = 'none' THEN 'neutral' WHEN coalesce(fresh, false) THEN 'good'
    WHEN delta IS NULL THEN 'neutral'
    WHEN (way = 'up' AND delta > 0.1) OR (way = 'down' AND delta < -0.1) THEN 'good'
    WHEN (way = 'up' AND delta < -0.1) OR (way = 'down' AND delta > 0.1) THEN 'bad'
    ELSE 'neutral' END AS flag FROM d"""


@query("dupont_matrix", _MATRIX)
def dupont_matrix(t):
    return dupont.dupont_matrix(_daily(t))


@query(
    "delta_pct",
    """SELECT country, n, channel, CASE WHEN reg_prev = 0 AND reg_now = 0 THEN NULL
    WHEN reg_prev = 0 THEN 'Infinity'::DOUBLE
    ELSE (reg_now::DOUBLE - reg_prev::DOUBLE) / reg_prev::DOUBLE END AS delta FROM v_pop""",
)
def delta_pct(t):
    rows = dupont.period_over_period(_daily(t))
    change = dupont.delta_pct(F.col("reg_now"), F.col("reg_prev"))
    return rows.select("country", "n", "channel", change.alias("delta"))


@query(
    "significance_flag",
    """SELECT country, n, channel,
    CASE WHEN cal_prev = 0 AND cal_now = 0 THEN 'neutral' WHEN cal_prev = 0 THEN 'good'
      WHEN (cal_now::DOUBLE - cal_prev::DOUBLE) / cal_prev::DOUBLE > 0.1 THEN 'good'
      WHEN (cal_now::DOUBLE - cal_prev::DOUBLE) / cal_prev::DOUBLE < -0.1 THEN 'bad'
      ELSE 'neutral' END AS flag FROM v_pop""",
)
def significance_flag(t):
    rows = dupont.period_over_period(_daily(t))
    change = dupont.delta_pct(F.col("cal_now"), F.col("cal_prev"))
    return rows.select(
        "country", "n", "channel", dupont.significance_flag(change, "up").alias("flag")
    )


@query(
    "share_of_total",
    """SELECT country, n, channel, CASE WHEN sum(cal_now) OVER w > 0
    THEN cal_now::DOUBLE / (sum(cal_now) OVER w)::DOUBLE END AS share_cal
    FROM v_pop WINDOW w AS (PARTITION BY country, n)""",
)
def share_of_total(t):
    return dupont.share_of_total(dupont.period_over_period(_daily(t)))


_GROUP = """CASE WHEN channel = 'WEB' OR channel LIKE 'WEB %' THEN 0
  WHEN channel LIKE 'Estudio Inmueble%' THEN 1
  WHEN regexp_matches(channel, '^(lead_forms|lead forms)', 'i') THEN 2
  WHEN regexp_matches(channel, '^(broker|crm|comercial)', 'i') THEN 3 ELSE 4 END"""


@query(
    "rank_within_group",
    f"""WITH g AS (SELECT *, {_GROUP} AS grp FROM v_pop)
    SELECT country, n, channel, grp, CAST(row_number() OVER (PARTITION BY country, n
      ORDER BY grp, spend_now DESC NULLS LAST, channel NULLS LAST) AS INT) AS position FROM g""",
)
def rank_within_group(t):
    out = dupont.rank_within_group(dupont.period_over_period(_daily(t)), "spend_now")
    return out.select("country", "n", "channel", "grp", "position")


# --- Q16 to Q18 ------------------------------------------------------------------------
VIEWS["first_in_window"] = f"""
SELECT country, deal_id, min(ts) AS first_at FROM v_state_log_mm
WHERE state_id IN (20, 63) AND deal_id IS NOT NULL GROUP BY country, deal_id
HAVING min(ts) >= {FIRST_CAL} AND min(ts) < {END}"""
VIEWS["mart_week"] = f"""
SELECT * REPLACE (CASE country WHEN 'colombia' THEN 'CO' ELSE 'MX' END AS country),
  {sql_bucket('day', 'W')} AS week FROM v_assigned_mart
WHERE day >= {FIRST} AND day < {END} AND ((country = 'colombia' AND source_id IN (3,7,20,35,39,47))
  OR (country = 'mexico' AND source_id IN (3,7,35,39,46,47)))"""
VIEWS["spend_source"] = f"""
SELECT *, {sql_bucket('date', 'W')} AS week, CASE acquisition_channel WHEN 'Web' THEN 3
  WHEN 'Lead Form' THEN 47 WHEN 'Estudio' THEN CASE WHEN country = 'CO' THEN 7 END
  WHEN 'Calculadora de gastos' THEN CASE WHEN country = 'CO' THEN 7 END END AS source_id
FROM v_spend WHERE date >= {FIRST} AND date < {END}"""
_WEEK_TEXT = "CAST(k.week AS STRING) AS week_start"


def _assembled(keys: list[str], reg: str, cal: str, asg: str, money: str, sums: list[str]) -> str:
    """Distinct union of the key sets and one left join per metric."""
    on = {a: " AND ".join(f"{a}.{k} = k.{k}" for k in keys) for a in "rcas"}
    cols = ", ".join(keys)
    return f"""WITH r AS ({reg}), c AS ({cal}), a AS ({asg}), s AS ({money}),
k AS (SELECT {cols} FROM r UNION SELECT {cols} FROM c UNION SELECT {cols} FROM a UNION SELECT {cols} FROM s)
SELECT {{out}}, coalesce(r.n, 0) AS reg, coalesce(c.n, 0) AS cal, coalesce(a.n, 0) AS asg,
{', '.join(f's.{x}' for x in sums)}
FROM k LEFT JOIN r ON {on['r']} LEFT JOIN c ON {on['c']} LEFT JOIN a ON {on['a']} LEFT JOIN s ON {on['s']}"""


_BY_SOURCE = _assembled(
    ["country", "week", "source_id"],
    f"""SELECT country, {sql_bucket('created_at', 'W')} AS week, source_id, count(*) AS n FROM v_leads
    WHERE {_OFFICIAL} AND created_at >= {FIRST} AND created_at < {END} GROUP BY ALL""",
    f"""SELECT country, {sql_bucket('first_at', 'W')} AS week, source_id, count(*) AS n
    FROM v_first_in_window JOIN v_leads USING (country, deal_id) WHERE {_OFFICIAL} GROUP BY ALL""",
    "SELECT country, week, source_id, count(*) AS n FROM v_mart_week GROUP BY ALL",
    """SELECT country, week, source_id, CAST(round(sum(spend), 0) AS DOUBLE) AS spend FROM v_spend_source
    WHERE source_id IS NOT NULL GROUP BY ALL""",
    ["spend"],
).format(out=f"k.country, {_WEEK_TEXT}, {_SOURCE.replace('source_id', 'k.source_id')} AS source")


@query("weekly_by_source", _BY_SOURCE)
def weekly_by_source(t):
    return weekly.weekly_by_source(t.leads, t.state_log_mm, t.assigned_mart, t.spend, AS_OF)


@query("assemble_metrics_using", _BY_SOURCE)
def assemble_metrics_using(t):
    return weekly.weekly_by_source(t.leads, t.state_log_mm, t.assigned_mart, t.spend, AS_OF)


@query(
    "assemble_metrics_by_campaign",
    f"""WITH c AS (SELECT country, {sql_bucket('created_at', 'M')} AS month, campaign, count(*) AS leads
      FROM v_leads GROUP BY ALL),
    o AS (SELECT country, {sql_bucket('created_at', 'M')} AS month, campaign, count(*) AS owned
      FROM v_leads WHERE owner_id IS NOT NULL GROUP BY ALL),
    s AS (SELECT country, {sql_bucket('date', 'M')} AS month, campaign, sum(clicks) AS clicks FROM v_spend GROUP BY ALL),
    k AS (SELECT country, month, campaign FROM c UNION SELECT country, month, campaign FROM o
      UNION SELECT country, month, campaign FROM s)
    SELECT country, CAST(month AS STRING) AS month, campaign, CAST(coalesce(leads, 0) AS BIGINT) AS leads,
      CAST(coalesce(owned, 0) AS BIGINT) AS owned, CAST(clicks AS BIGINT) AS clicks
    FROM k LEFT JOIN c USING (country, month, campaign) LEFT JOIN o USING (country, month, campaign)
    LEFT JOIN s USING (country, month, campaign)""",
)
def assemble_metrics_by_campaign(t):
    keys = ["country", "month", "campaign"]
    month = lambda c: F.trunc(c, "MONTH").alias("month")
    leads = t.leads.select("country", month("created_at"), "campaign", "owner_id")
    counted = leads.groupBy(*keys).agg(F.count("*").alias("leads"))
    owned = leads.where(F.col("owner_id").isNotNull()).groupBy(*keys).agg(F.count("*").alias("owned"))
    clicks = t.spend.select("country", month("date"), "campaign", "clicks").groupBy(*keys).agg(F.sum("clicks").alias("clicks"))
    out = joins.assemble_metrics([counted, owned, clicks], keys, ["leads", "owned"], ["clicks"])
    return out.withColumns({"month": F.col("month").cast("string"), "clicks": F.col("clicks").cast("long")})


def _metrics(table: str, keys: str) -> tuple[str, str, str, str]:
    recent = f"(SELECT * FROM {table} WHERE created_at >= {YEAR})"
    extra = "AND platform IS NOT NULL AND platform <> ''" if "platform" in keys else ""
    return (
        f"""SELECT country, {sql_bucket('created_at', 'W')} AS week, {keys}, count(*) AS n FROM {recent}
        WHERE created_at >= {FIRST} AND created_at < {END} GROUP BY ALL""",
        f"""SELECT country, {sql_bucket('first_at', 'W')} AS week, {keys}, count(*) AS n
        FROM v_first_in_window JOIN {recent} l USING (country, deal_id) GROUP BY ALL""",
        f"""SELECT m.country, week, {', '.join('l.' + k for k in keys.split(', '))}, count(*) AS n
        FROM v_mart_week m JOIN {recent} l ON l.country = m.country AND l.asset_id = m.asset_id
        GROUP BY ALL""",
        f"""SELECT country, {sql_bucket('date', 'W')} AS week, {keys},
        CAST(round(sum(spend), 0) AS DOUBLE) AS spend, CAST(round(sum(clicks), 0) AS DOUBLE) AS clicks,
        CAST(round(sum(impressions), 0) AS DOUBLE) AS impressions
        FROM v_paid WHERE date >= {FIRST} AND date < {END} AND source IS NOT NULL {extra} GROUP BY ALL""",
    )


_SUMS = ["spend", "clicks", "impressions"]
_BY_CHANNEL = _assembled(
    ["country", "week", "channel", "source"], *_metrics("v_lead_channel", "channel, source"), _SUMS
).format(out=f"k.country, {_WEEK_TEXT}, k.channel, k.source")
_BY_PLATFORM = _assembled(
    ["country", "week", "platform", "channel", "source"],
    *_metrics("v_lead_platform", "platform, channel, source"),
    _SUMS,
).format(out=f"k.country, {_WEEK_TEXT}, k.platform, k.channel, k.source")


def _weekly_channel(t):
    return weekly.weekly_by_channel(
        t.leads, t.state_log_mm, t.assigned_mart, t.dictionary, t.spend, AS_OF
    )


@query("weekly_by_channel", _BY_CHANNEL)
def weekly_by_channel(t):
    return _weekly_channel(t)


@query("weekly_by_platform", _BY_PLATFORM)
def weekly_by_platform(t):
    return weekly.weekly_by_platform(
        t.leads, t.state_log_mm, t.assigned_mart, t.dictionary, t.spend, AS_OF
    )


_NAME_RULES = """CASE WHEN channel = 'WEB' OR channel LIKE 'WEB %' THEN 'WEB'
  WHEN channel LIKE 'Estudio Inmueble%' THEN 'Estudio Inmueble'
  WHEN starts_with(channel, 'lead_forms') OR starts_with(channel, 'Lead Forms') THEN 'lead_forms'
  WHEN channel LIKE 'Broker%' THEN 'Broker' WHEN channel LIKE 'CRM%' THEN 'CRM'
  WHEN channel LIKE 'Propiedades%' THEN 'Propiedades'
  WHEN lower(channel) LIKE 'comercial%' THEN 'Comercial' END"""
VIEWS["by_channel"] = _BY_CHANNEL
VIEWS["by_source"] = _BY_SOURCE


@query(
    "recollapse_channels",
    f"""SELECT country, week_start, channel, coalesce({_NAME_RULES}, min(source)) AS source,
    {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in ('reg', 'cal', 'asg', *_SUMS))}
    FROM v_by_channel GROUP BY country, week_start, channel""",
)
def recollapse_channels(t):
    return channels.recollapse_channels(_weekly_channel(t))


@query(
    "null_aware_sum",
    """SELECT country, channel, CAST(sum(spend) AS DOUBLE) AS spend, CAST(sum(clicks) AS DOUBLE) AS clicks
    FROM v_by_channel GROUP BY ALL""",
)
def null_aware_sum(t):
    """A sum over nothing stays NULL instead of becoming 0."""
    return _weekly_channel(t).groupBy("country", "channel").agg(
        F.sum("spend").alias("spend"), F.sum("clicks").alias("clicks")
    )


# --- scalar rules on whole tables ---------------------------------------------------------
@query(
    "resolve_channel",
    """SELECT deal_id, country, source_id, channel FROM v_lead_channel""",
)
def resolve_channel(t):
    leads = t.leads.where(weekly.official_source())
    out = channels.attach_channel(leads, t.dictionary)
    return out.select("deal_id", "country", "source_id", "channel")


@query(
    "resolve_channel_tracked_only",
    "SELECT deal_id, country, source_id, channel, platform FROM v_lead_platform",
)
def resolve_channel_tracked_only(t):
    leads = t.leads.where(weekly.official_source())
    out = channels.attach_channel_tracked(leads, t.dictionary)
    return out.select("deal_id", "country", "source_id", "channel", "platform")


@query(
    "collapse_paid_direct",
    """SELECT country, channel, count(*) AS n FROM v_paid GROUP BY ALL""",
)
def collapse_paid_direct(t):
    counts = t.spend.groupBy("country", "campaign").agg(F.count("*").alias("n"))
    known = channels.dictionary_by(t.dictionary, "campaign_name")
    rows = counts.join(known.where(F.col("channel_medium").isNotNull()), "campaign")
    medium = F.col("channel_medium")
    channel = channels.per_country(lambda s: text.collapse_paid_direct(medium, s.lead_form_aliases))
    return rows.groupBy("country", channel.alias("channel")).agg(F.sum("n").alias("n"))


@query(
    "channel_to_source_prefix",
    f"""SELECT row_no, country, {_MEDIUM_SOURCE} AS source
    FROM v_dictionary CROSS JOIN (VALUES ('CO'), ('MX')) c(country)""",
)
def channel_to_source_prefix(t):
    both = F.explode(F.array(F.lit("CO"), F.lit("MX"))).alias("country")
    rows = t.dictionary.select("row_no", "channel_medium", both)
    medium = F.col("channel_medium")
    source = channels.per_country(
        lambda s: text.channel_to_source(medium, s.spend_prefixes, s.lead_form_aliases[:2])
    )
    return rows.select("row_no", "country", source.alias("source"))


@query(
    "channel_group_rank",
    f"""SELECT channel, {_GROUP} AS grp, count(*) AS n FROM v_lead_channel GROUP BY ALL""",
)
def channel_group_rank(t):
    leads = t.leads.where(weekly.official_source())
    counts = leads.groupBy("source_name", "campaign").agg(F.count("*").alias("n"))
    rows = channels.attach_channel(counts, t.dictionary)
    grp = text.channel_group_rank(F.col("channel")).alias("grp")
    return rows.groupBy("channel", grp).agg(F.sum("n").alias("n"))


@query(
    "spend_to_source",
    """SELECT country, acquisition_channel, source_id, count(*) AS n, CAST(sum(spend) AS DOUBLE) AS spend
    FROM v_spend_source WHERE source_id IS NOT NULL GROUP BY ALL""",
)
def spend_to_source(t):
    rows = weekly.spend_to_source(scan_spend(t.spend, W.first, W.end))
    return rows.groupBy("country", "acquisition_channel", "source_id").agg(
        F.count("*").alias("n"), F.sum("spend").cast("double").alias("spend")
    )


@query(
    "sum_spend_rounded",
    f"""SELECT country, CAST({sql_bucket('date', 'W')} AS STRING) AS week,
    {', '.join(f'CAST(round(sum({c}), 0) AS DOUBLE) AS {c}' for c in _SUMS)} FROM v_spend GROUP BY ALL""",
)
def sum_spend_rounded(t):
    week = iso_week_start(F.to_date("date")).cast("string").alias("week")
    return t.spend.groupBy("country", week).agg(
        *[F.round(F.sum(c), 0).cast("double").alias(c) for c in _SUMS]
    )


@query(
    "join_dictionary",
    """SELECT deal_id, country, l.campaign, channel_medium, platform
    FROM v_leads l LEFT JOIN v_dict_lead d ON l.campaign = d.campaign""",
)
def join_dictionary(t):
    rows = t.leads.select("deal_id", "country", "campaign")
    known = channels.dictionary_by(t.dictionary, "campaign_original")
    return joins.left_join_spread(rows, known, on=["campaign"], nullable="campaign")


@query(
    "join_spend_dictionary",
    f"""SELECT country, s.campaign, channel_medium, count(*) AS n, CAST(sum(spend) AS DOUBLE) AS spend
    FROM v_spend s LEFT JOIN v_dict_spend d ON s.campaign = d.campaign
    WHERE channel_medium IS NOT NULL AND date >= {D180} AND date < {D} GROUP BY ALL""",
)
def join_spend_dictionary(t):
    rows = scan_spend(t.spend, lookback_start(AS_OF, 180), AS_OF)
    counts = rows.groupBy("country", "campaign").agg(
        F.count("*").alias("n"), F.sum("spend").cast("double").alias("spend")
    )
    known = channels.dictionary_by(t.dictionary, "campaign_name").drop("platform")
    return counts.join(known, "campaign", "left").where(F.col("channel_medium").isNotNull())


@query(
    "spend_match_rate",
    f"""WITH j AS (SELECT s.*, channel_medium FROM v_spend s
      LEFT JOIN v_dict_spend d ON s.campaign = d.campaign WHERE date >= {D180} AND date < {D})
    SELECT country, CAST(sum(spend) AS DOUBLE) AS total,
    CAST(sum(CASE WHEN channel_medium IS NULL THEN spend ELSE 0 END) AS DOUBLE) AS unmatched,
    100.0::DOUBLE * CAST(sum(CASE WHEN channel_medium IS NULL THEN spend ELSE 0 END) AS DOUBLE)
      / CAST(sum(spend) AS DOUBLE) AS pct_unmatched FROM j GROUP BY ALL""",
)
def spend_match_rate(t):
    rows = scan_spend(t.spend, lookback_start(AS_OF, 180), AS_OF)
    return channels.spend_match_rate(rows, t.dictionary)


@query("dedup_first", "SELECT * FROM v_dict_lead")
def dedup_first(t):
    return channels.dictionary_by(t.dictionary, "campaign_original")


@query(
    "union_distinct_keys",
    f"""SELECT DISTINCT CAST(week AS STRING) AS week, source_id FROM (
    SELECT {sql_bucket('created_at', 'W')} AS week, source_id FROM v_leads
      WHERE {_OFFICIAL} AND created_at >= {FIRST} AND created_at < {END}
    UNION SELECT week, source_id FROM v_mart_week
    UNION SELECT week, source_id FROM v_spend_source WHERE source_id IS NOT NULL)""",
)
def union_distinct_keys(t):
    leads = scan_leads(t.leads, W.end, first=W.first)
    keys = leads.select(iso_week_start(F.col("created")).alias("week"), "source_id")
    mart = weekly.mart_in_window(t.assigned_mart, W).select("week", "source_id")
    paid = weekly.spend_to_source(scan_spend(t.spend, W.first, W.end))
    paid = paid.select(iso_week_start(F.col("day")).alias("week"), "source_id")
    out = keys.union(mart).union(paid).distinct()
    return out.withColumn("week", F.col("week").cast("string"))


# --- events attributed to leads --------------------------------------------------------------
@query(
    "attribute_events_to_leads",
    f"""SELECT country, source_id, CAST({sql_bucket('first_at', 'W')} AS STRING) AS week, count(*) AS n
    FROM v_first_mm JOIN v_leads USING (country, deal_id) GROUP BY ALL""",
)
def attribute_events_to_leads(t):
    first = events.first_event(t.state_log_mm, (20, 63))
    rows = events.attribute_events_to_leads(first, t.leads.select("country", "deal_id", "source_id"))
    week = iso_week_start(F.to_date("first_at")).cast("string").alias("week")
    return rows.groupBy("country", "source_id", week).agg(F.count("*").alias("n"))


@query(
    "attribute_assignments",
    """SELECT m.country, CAST(week AS STRING) AS week, l.source_id, count(*) AS asg FROM v_mart_week m
    JOIN v_leads l ON l.country = m.country AND l.asset_id = m.asset_id GROUP BY ALL""",
)
def attribute_assignments(t):
    mart = weekly.mart_in_window(t.assigned_mart, W)
    out = weekly.attribute_assignments(mart, t.leads, ["source_id"])
    return out.withColumn("week", F.col("week").cast("string"))


@query(
    "first_event_date",
    "SELECT country, deal_id, CAST(CAST(first_at AS DATE) AS STRING) AS first_date FROM v_first_mm",
)
def first_event_date(t):
    out = events.first_event_date(t.state_log_mm, (20, 63))
    return out.withColumn("first_date", F.col("first_date").cast("string"))


@query(
    "first_event_in_window",
    "SELECT country, deal_id, CAST(first_at AS STRING) AS first_at FROM v_first_in_window",
)
def first_event_in_window(t):
    out = events.first_event_in_window(t.state_log_mm, (20, 63), W.first_cal, W.end)
    return out.withColumn("first_at", F.col("first_at").cast("string"))


@query(
    "first_windowed_event",
    f"""SELECT country, deal_id, CAST(min(ts) AS STRING) AS first_at FROM v_state_log_mm
    WHERE state_id IN (20, 63) AND deal_id IS NOT NULL AND ts >= {FIRST_CAL} GROUP BY ALL""",
)
def first_windowed_event(t):
    first = F.lit(str(W.first_cal)).cast("timestamp_ntz")
    out = events.first_windowed_event(t.state_log_mm, (20, 63), first)
    return out.withColumn("first_at", F.col("first_at").cast("string"))
