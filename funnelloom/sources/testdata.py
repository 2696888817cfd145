"""Canonical tables as views over the sample parquet tables.

The sample data is order-shaped, so each canonical table is a projection of one
sample table. A projection is written once as SQL text that Spark and the SQL
oracle both accept; raw columns keep their plain form wherever possible so that
date filters and column pruning reach the parquet scan.
"""

from __future__ import annotations

import datetime as dt
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from funnelloom.sources.target_sheet import sample_sheet

# Reference day of the order-based tables, and reference instant of the event-based ones.
AS_OF = dt.date(2001, 8, 1)
WEB_AS_OF = dt.date(2024, 1, 30)
NOW_UTC = dt.datetime(2024, 1, 30, 19, 30)
CREATIVE_START = dt.date(2001, 6, 20)
QUALITY_START = dt.date(2000, 1, 1)
CREATIVE = "creative_one"
QUALITY_CAMPAIGNS = ("Brand#1", "Brand#4", "Brand#8", "Brand#13", "Brand#21", "Brand#28")

_ORDER_COUNTRY = "CASE WHEN o_orderkey % 5 < 3 THEN 'CO' ELSE 'MX' END"
_LINE_COUNTRY = "CASE WHEN l_orderkey % 5 < 3 THEN 'CO' ELSE 'MX' END"
_SOURCE_ID = (
    "CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 7 "
    "WHEN '3-MEDIUM' THEN CASE WHEN o_orderkey % 5 < 3 THEN 20 ELSE 46 END "
    "WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderkey % 2 = 0 THEN 35 ELSE 39 END "
    "ELSE CASE o_orderkey % 8 WHEN 0 THEN 37 WHEN 1 THEN 1 ELSE 47 END END AS INT)"
)
_SOURCE_NAME = (
    "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'WEB' "
    "WHEN '2-HIGH' THEN 'Estudio Inmueble' WHEN '3-MEDIUM' THEN "
    "CASE WHEN o_orderkey % 5 < 3 THEN 'CRM' ELSE 'Propiedades' END "
    "WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'comercial' ELSE 'Broker' END "
    "ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'Lead Forms' ELSE 'lead_forms' END END END"
)
_EVENT_DEAL = "CAST(floor(event_id / 3) AS BIGINT)"
_EVENT_COUNTRY = "CASE WHEN CAST(floor(event_id / 3) AS BIGINT) % 2 = 0 THEN 'CO' ELSE 'MX' END"
_V = "CAST(floor(o_totalprice) AS BIGINT)"

# table -> (sample table, {column: expression}, row condition or None)
BINDINGS: dict[str, tuple[str, dict[str, str], str | None]] = {
    "leads": (
        "orders",
        {
            "country": _ORDER_COUNTRY,
            "deal_id": "CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderkey END",
            "asset_id": "CASE WHEN o_custkey % 8 = 0 THEN NULL ELSE o_custkey END",
            "source_id": _SOURCE_ID,
            "source_name": _SOURCE_NAME,
            "created_at": "o_orderdate",
            "campaign": "CASE WHEN o_custkey % 7 = 0 THEN NULL WHEN o_custkey % 11 = 0 THEN '' "
            "ELSE concat('Brand#', CAST(1 + o_orderkey % 30 AS STRING)) END",
            "owner_id": "CASE WHEN o_orderkey % 6 = 0 THEN NULL "
            "ELSE CAST(o_orderkey % 120 AS STRING) END",
            "first_assigned_at": "CASE WHEN o_orderkey % 4 = 0 THEN NULL "
            "ELSE o_orderdate + INTERVAL '1' DAY END",
            "state_text": "CASE o_orderkey % 7 WHEN 0 THEN 'Sin_pricing_incial' "
            "WHEN 1 THEN ' sin pricing inicial' WHEN 2 THEN 'No gestionado' WHEN 3 THEN 'CIERRE' "
            "WHEN 4 THEN 'no hay suficientes datos para comparar' "
            "WHEN 5 THEN 'Visita agendada' ELSE NULL END",
            "rating": "CASE o_orderkey % 9 WHEN 0 THEN 'N' WHEN 1 THEN ' nh ' WHEN 2 THEN NULL "
            "ELSE 'A' END",
            "priced": "CAST(CASE o_custkey % 4 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE 1 END AS INT)",
            "listing": "CASE o_orderkey % 10 WHEN 0 THEN '1' WHEN 1 THEN 'x1' WHEN 2 THEN NULL "
            "ELSE '0' END",
        },
        None,
    ),
    # One row per deal, kept by the CRM itself: it need not agree with the log.
    "deal_states": (
        "orders",
        {
            "country": _ORDER_COUNTRY,
            "deal_id": "CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderkey END",
            "state_id": "CAST(CASE o_orderkey % 8 WHEN 0 THEN 20 WHEN 1 THEN 63 WHEN 2 THEN 7 WHEN 3 THEN 39 "
            "WHEN 4 THEN 3 WHEN 5 THEN 1 WHEN 6 THEN 33 ELSE NULL END AS INT)",
            "inmo_state_id": "CAST(CASE o_orderkey % 5 WHEN 0 THEN 20 WHEN 1 THEN 7 WHEN 2 THEN 16 ELSE NULL END AS INT)",
        },
        "o_orderkey % 9 <> 4",
    ),
    "state_log_mm": (
        "lineitem",
        {
            "country": _LINE_COUNTRY,
            "track": "'mm'",
            "deal_id": "CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE l_orderkey END",
            "state_id": "CAST(CASE WHEN l_returnflag = 'R' THEN "
            "CASE WHEN l_linestatus = 'O' THEN 20 ELSE 63 END WHEN l_returnflag = 'A' THEN "
            "CASE WHEN l_linestatus = 'O' THEN 7 ELSE 39 END ELSE "
            "CASE WHEN l_linestatus = 'O' THEN 3 ELSE 1 END END AS INT)",
            "ts": "l_shipdate",
            "seq": "l_linenumber",
        },
        None,
    ),
    # The second track's log starts later than the first.
    "state_log_inmo": (
        "lineitem",
        {
            "country": _LINE_COUNTRY,
            "track": "'inmo'",
            "deal_id": "CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE l_orderkey END",
            "state_id": "CAST(CASE WHEN l_returnflag = 'A' THEN "
            "CASE WHEN l_linestatus = 'O' THEN 20 ELSE 12 END WHEN l_returnflag = 'R' THEN 4 "
            "ELSE 9 END AS INT)",
            "ts": "l_shipdate",
            "seq": "l_linenumber",
        },
        "l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'",
    ),
    "stage_log": (
        "lineitem",
        {
            "country": _LINE_COUNTRY,
            "asset_id": "l_partkey",
            "team": "CASE WHEN l_orderkey % 5 < 3 THEN "
            "CASE WHEN l_suppkey % 8 < 4 THEN 'Exclusivo inmobiliaria CO' ELSE 'Ventas' END "
            "ELSE CASE l_suppkey % 8 WHEN 0 THEN 'Inmobiliaria 1' WHEN 1 THEN 'Inmobiliaria 2' "
            "WHEN 2 THEN 'Inmo ciudades MX' WHEN 3 THEN 'Inmobliaria mx' WHEN 4 THEN 'Inmo puebla' "
            "ELSE 'Ventas' END END",
            "stage": "CASE l_linenumber WHEN 1 THEN CASE WHEN l_orderkey % 5 < 3 "
            "THEN 'Primer_asigancion' ELSE 'Primer asignacion' END "
            "WHEN 2 THEN CASE WHEN l_quantity > 25 THEN 'Cita Agendada (hubspot)' "
            "ELSE 'Cita Agendada' END "
            "WHEN 3 THEN CASE WHEN l_quantity > 25 THEN 'Visita Efectuada (hubspot)' "
            "ELSE 'Visita Efectuada' END "
            "WHEN 4 THEN CASE WHEN l_quantity > 25 THEN 'Aprobado General' "
            "ELSE 'Primer inmueble aprobado' END "
            "WHEN 5 THEN 'Acepto Oferta - Pendiente firma' WHEN 6 THEN 'Cierre - Comprado' "
            "ELSE 'Otro' END",
            "ts": "l_shipdate",
        },
        None,
    ),
    "state_catalogue": (
        "nation",
        {"state_id": "CAST(n_nationkey AS INT)", "name": "concat('Estado ', n_name)"},
        None,
    ),
    "dictionary": (
        "part",
        {
            "row_no": "p_partkey",
            "campaign_original": "p_brand",
            "campaign_name": "concat('Ads ', p_brand)",
            "channel_medium": "CASE p_type WHEN 'STANDARD' THEN 'WEB Paid' WHEN 'PROMO' THEN "
            "'WEB Organic' WHEN 'LARGE' THEN 'Estudio Inmueble Paid' WHEN 'SMALL' THEN "
            "'lead_forms Paid' WHEN 'ECONOMY' THEN 'Propiedades Paid' ELSE NULL END",
            "platform": "CASE p_size % 4 WHEN 0 THEN 'Facebook' WHEN 1 THEN 'Google' "
            "WHEN 2 THEN '' ELSE 'TikTok' END",
        },
        None,
    ),
    "spend": (
        "lineitem",
        {
            "country": "CASE WHEN l_suppkey % 2 = 0 THEN 'CO' ELSE 'MX' END",
            "date": "l_shipdate",
            "campaign": "concat('Ads Brand#', CAST(1 + l_partkey % 30 AS STRING))",
            "acquisition_channel": "CASE l_linenumber WHEN 1 THEN 'Web' WHEN 2 THEN 'Estudio' "
            "WHEN 3 THEN 'Calculadora de gastos' WHEN 4 THEN 'Lead Form' WHEN 5 THEN 'Brand' "
            "ELSE 'Otro' END",
            "spend": "CAST(l_extendedprice AS DECIMAL(18,2))",
            "clicks": "CAST(l_quantity AS DECIMAL(18,2))",
            "impressions": "CAST(100 * l_quantity AS DECIMAL(18,2))",
        },
        None,
    ),
    "ad_region_spend": (
        "lineitem",
        {
            "date_start": "l_shipdate",
            "campaign_name": "concat('Brand#', CAST(1 + l_partkey % 30 AS STRING))",
            "ad_name": "CASE l_suppkey % 10 WHEN 0 THEN 'Creative_One_colab' "
            "WHEN 1 THEN 'CREATIVE_ONE' WHEN 2 THEN 'CreativeXOne_copy' ELSE 'Generic ad' END",
            "spend": "CAST(l_extendedprice AS DECIMAL(18,2))",
        },
        None,
    ),
    "deal_utm": (
        "orders",
        {
            "deal_id": "CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderkey END",
            "utm_content": "CASE o_orderkey % 6 WHEN 0 THEN 'Creative_One' WHEN 1 THEN "
            "'creative_one' WHEN 2 THEN 'creativeXone' ELSE 'other' END",
        },
        None,
    ),
    "assigned_mart": (
        "orders",
        {
            "country": "CASE WHEN o_orderkey % 5 < 3 THEN 'colombia' ELSE 'mexico' END",
            "asset_id": "o_custkey",
            "source_id": _SOURCE_ID,
            "day": "CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INT)",
        },
        "o_orderstatus = 'F'",
    ),
    "crm_deals": (
        "orders",
        {
            "asset_id": "CASE WHEN o_custkey % 8 = 0 THEN NULL ELSE o_custkey END",
            "country": "CASE WHEN o_orderkey % 5 < 3 THEN 'Colombia' ELSE 'México' END",
            "created": "o_orderdate",
            "ask_price": "CASE WHEN o_totalprice < 90000 THEN NULL ELSE o_totalprice END",
            "priority": "CASE o_orderpriority WHEN '1-URGENT' THEN 'A' WHEN '2-HIGH' THEN 'B' "
            "WHEN '3-MEDIUM' THEN 'C' WHEN '5-LOW' THEN NULL ELSE 'D' END",
        },
        None,
    ),
    "owners": (
        "supplier",
        {
            "secondary_id": "s_suppkey",
            "email": "CASE WHEN s_suppkey % 4 = 0 THEN concat(s_name, '@Other.org') "
            "WHEN s_suppkey % 10 = 3 THEN concat('Agente', s_name, '@Casa.example') "
            "WHEN s_suppkey % 10 = 5 THEN NULL ELSE concat(s_name, '@Casa.example') END",
        },
        None,
    ),
    "owner_changes": (
        "orders",
        {
            "asset_id": "o_custkey",
            "owner_id": "CAST(o_orderkey % 120 AS STRING)",
            "changed_at": "o_orderdate",
            "seq": "o_orderkey",
        },
        None,
    ),
    "deal_info": (
        "customer",
        {
            "asset_id": "c_custkey",
            "state_text": "CASE c_custkey % 6 WHEN 0 THEN 'Sin pricing incial' WHEN 1 THEN "
            "' no gestionado' WHEN 2 THEN 'CIERRE' WHEN 3 THEN "
            "'no hay suficientes datos para comparar' WHEN 4 THEN NULL ELSE 'Otra' END",
            "digital_contact": "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END",
        },
        None,
    ),
    "pageviews": (
        "events",
        {
            "anonymous_id": "CASE WHEN user_id % 37 = 0 THEN NULL ELSE CAST(user_id AS STRING) END",
            "path": "CASE event_type WHEN 'view' THEN CASE {K} % 4 "
            "WHEN 0 THEN '/formulario-inmueble/direccion' "
            "WHEN 1 THEN '/formulario-inmueble/inmuebles-zona' "
            "WHEN 2 THEN '/formulario-inmueble/confirmar-ubicacion' "
            "ELSE '/formulario-inmueble/sugerencias' END "
            "WHEN 'click' THEN CASE WHEN {K} % 10 = 9 THEN '/blog' "
            "ELSE '/formulario-inmueble/datos-inmueble' END "
            "WHEN 'signup' THEN '/formulario-inmueble/contacto' "
            "WHEN 'error' THEN CASE {K} % 3 WHEN 0 THEN '/formulario-inmueble/caracteristicas' "
            "WHEN 1 THEN '/formulario-inmueble/ultimos-detalles' "
            "ELSE '/formulario-inmueble/otra' END "
            "ELSE '/formulario-inmueble/felicitaciones' END",
            "url": "CASE WHEN {K} % 5 = 0 THEN 'https://site.example/f?utm_content=help_to_sell' "
            "WHEN {K} % 50 = 7 THEN 'https://site.example/f?utmXcontent=help_to_sell' "
            "ELSE 'https://site.example/f' END",
            "referrer": "CASE WHEN {K} % 20 = 3 THEN 'https://ayudaventas-web.example/a' "
            "WHEN {K} % 2 = 0 THEN NULL ELSE 'https://search.example' END",
            "event_name": "event_type",
            "ts": "ts",
        },
        None,
    ),
    "select_content": (
        "events",
        {
            "anonymous_id": "CAST(user_id AS STRING)",
            "backbone_uuid": "CASE WHEN {K} % 9 = 8 THEN NULL "
            "ELSE concat('u', CAST(event_id AS STRING)) END",
            "ts": "ts",
        },
        "event_type = 'click'",
    ),
    "session_bridge": (
        "events",
        {
            "uuid": "concat('u', CAST(event_id AS STRING))",
            "deal_uuid": "CASE WHEN {K} >= 90 THEN NULL ELSE concat('d', CAST(30 * {K} + "
            "CASE WHEN {K} % 3 = 0 THEN 1 ELSE 0 END + extract(day FROM ts) AS STRING)) END",
        },
        "event_type = 'click'",
    ),
    "web_deals": (
        "orders",
        {
            "deal_uuid": "concat('d', CAST(o_orderkey AS STRING))",
            "asset_id": "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey END",
        },
        None,
    ),
    "web_leads": (
        "orders",
        {
            "asset_id": "o_orderkey",
            "created_at": "CAST('2024-01-01' AS DATE) + CAST((o_orderkey + 29) % 30 AS INT)",
        },
        None,
    ),
    "web_crm_deals": (
        "orders",
        {
            "created": "CAST('2024-01-01' AS DATE) + CAST(o_orderkey % 45 AS INT) "
            "+ INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT)",
            "sub_source": "CASE WHEN o_orderstatus = 'P' THEN 'Ayuda Venta' ELSE 'Otro' END",
        },
        None,
    ),
    "hourly_leads": (
        "events",
        {
            "country": _EVENT_COUNTRY,
            "deal_id": _EVENT_DEAL,
            "created_at": "ts",
            "source_id": "CAST(CASE user_id % 8 WHEN 0 THEN 3 WHEN 1 THEN 7 WHEN 2 THEN 20 "
            "WHEN 3 THEN 35 WHEN 4 THEN 39 WHEN 5 THEN 46 WHEN 6 THEN 47 ELSE 99 END AS INT)",
        },
        None,
    ),
    "hourly_log": (
        "events",
        {
            "country": _EVENT_COUNTRY,
            "deal_id": _EVENT_DEAL,
            "state_id": "CAST(CASE event_type WHEN 'purchase' THEN 20 WHEN 'error' THEN 63 "
            "ELSE 5 END AS INT)",
            "ts": "ts",
        },
        None,
    ),
    "sheet_text": (
        "orders",
        {
            "row_no": "o_orderkey",
            "number_text": "CASE o_orderkey % 8 WHEN 0 THEN '#N/A' WHEN 1 THEN '-' WHEN 2 THEN '' "
            "WHEN 3 THEN concat(CAST(o_custkey AS STRING), '%') "
            "WHEN 4 THEN concat(CAST(1 + o_custkey AS STRING), '.', "
            "lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0')) "
            "WHEN 5 THEN concat(CAST(o_custkey AS STRING), ',', CAST(o_orderkey % 10 AS STRING)) "
            "WHEN 6 THEN ' #REF! ' ELSE concat('  ', CAST(o_custkey AS STRING), ' ') END",
            "date_text": "CASE o_orderkey % 5 WHEN 0 THEN '31/02/2001' WHEN 1 THEN 'pendiente' "
            "ELSE concat(lpad(CAST(extract(day FROM o_orderdate) AS STRING), 2, '0'), '/', "
            "lpad(CAST(extract(month FROM o_orderdate) AS STRING), 2, '0'), '/', "
            "CAST(extract(year FROM o_orderdate) AS STRING)) END",
            "first_day": "CAST(o_orderdate AS DATE)",
            "last_day": "CAST(o_orderdate AS DATE) + 6",
        },
        None,
    ),
    "profiles": (
        "orders",
        {
            "source_id": _SOURCE_ID,
            "created_at": "o_orderdate",
            "incomplete_at": "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate END",
            "completed_at": f"CASE WHEN o_orderstatus = 'O' OR {_V} % 4 = 0 THEN NULL "
            f"WHEN {_V} % 4 = 1 THEN o_orderdate + INTERVAL '30' MINUTE "
            f"WHEN {_V} % 4 = 2 THEN o_orderdate + INTERVAL '60' MINUTE "
            "ELSE o_orderdate + INTERVAL '90' MINUTE END",
            "agent": f"CASE {_V} % 10 WHEN 0 THEN 'callcenter' WHEN 1 THEN 'bot' "
            "WHEN 2 THEN 'whatsapp' WHEN 3 THEN 'duplicates' WHEN 4 THEN 'pricing' "
            "WHEN 5 THEN 'docking' WHEN 6 THEN 'staff' WHEN 7 THEN 'someone' ELSE NULL END",
            "area": f"CASE WHEN {_V} % 5 = 0 THEN NULL ELSE {_V} % 200 END",
            "bath": f"CASE WHEN {_V} % 7 = 0 THEN NULL ELSE {_V} % 4 END",
            "rooms": f"CASE WHEN {_V} % 11 = 0 THEN NULL ELSE {_V} % 6 END",
            "age": f"CASE WHEN {_V} % 3 = 0 THEN NULL ELSE {_V} % 50 END",
            "garage": f"CASE WHEN {_V} % 6 = 0 THEN NULL ELSE {_V} % 3 END",
            "lift": f"CASE WHEN {_V} % 8 = 0 THEN NULL ELSE 1 END",
            "lot": f"CASE WHEN {_V} % 13 = 0 THEN NULL ELSE {_V} END",
            "address": f"CASE WHEN {_V} % 17 = 0 THEN NULL ELSE 'Calle' END",
            "type": f"CAST(CASE WHEN {_V} % 9 = 0 THEN NULL ELSE {_V} % 9 END AS INT)",
        },
        None,
    ),
}

# Declared schemas: no footer is read to plan a query.
SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
}

_SPARK_K = "CAST(get_json_object(props, '$.k') AS INT)"
_SQL_K = "CAST(json_extract_string(props, '$.k') AS INT)"


def _project(df: DataFrame, name: str) -> DataFrame:
    """Rows of a sample table as a canonical table. The JSON key is read once per row."""
    _, columns, condition = BINDINGS[name]
    if condition:
        df = df.where(condition)
    if any("{K}" in sql for sql in columns.values()):
        df = df.selectExpr("*", f"{_SPARK_K} AS __k")
    return df.selectExpr(*[f"{sql.replace('{K}', '__k')} AS {col}" for col, sql in columns.items()])


class Tables:
    """Lazy canonical tables over one folder of sample parquet files."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in BINDINGS:
            raise AttributeError(name)
        return _project(self.raw(BINDINGS[name][0]), name)

    @property
    def state_log(self) -> DataFrame:
        """Both tracks in one log, told apart by ``track``."""
        return self.state_log_mm.unionByName(self.state_log_inmo)

    @property
    def target_sheet(self) -> DataFrame:
        return sample_sheet(self.leads, AS_OF)


def stream_of(tables: Tables, name: str) -> DataFrame:
    """A canonical table as a stream over the same file."""
    table = BINDINGS[name][0]
    # The glob keeps the folder's other tables out of the stream.
    df = (
        tables.spark.readStream.schema(SCHEMAS[table])
        .option("pathGlobFilter", f"{table}.parquet")
        .parquet(tables.folder)
    )
    return _project(df, name)


@lru_cache(maxsize=None)
def oracle_view(name: str) -> str:
    """The same projection as SQL text for the oracle."""
    table, columns, condition = BINDINGS[name]
    cols = ", ".join(f"{sql.replace('{K}', _SQL_K)} AS {col}" for col, sql in columns.items())
    where = f" WHERE {condition}" if condition else ""
    return f"SELECT {cols} FROM {table}{where}"
