"""Streaming forms, checked against their batch results."""

from __future__ import annotations

from pyspark.sql import functions as F

from funnelloom.catalog.registry import query
from funnelloom.functions.dates import unix_micros_sql
from funnelloom.session import scratch_path
from funnelloom.sources.testdata import stream_of
from funnelloom.streaming import hourly


@query(
    "stream_hourly_counts",
    """WITH x AS (SELECT country, deal_id, created_at - to_hours(CASE country WHEN 'CO' THEN 5 ELSE 6 END) AS ts,
      CASE source_id WHEN 3 THEN 'WEB' WHEN 7 THEN 'Estudio' WHEN 20 THEN 'CRM' WHEN 35 THEN 'Comercial'
        WHEN 39 THEN 'Broker' WHEN 46 THEN 'Propiedades' WHEN 47 THEN 'Leadforms' END AS source
      FROM v_hourly_leads WHERE deal_id IS NOT NULL AND source_id IN (3,7,20,35,39,46,47))
    SELECT country, CAST(CAST(ts AS DATE) AS STRING) AS local_date, CAST(hour(ts) + 1 AS INT) AS hour,
      source, count(DISTINCT deal_id) AS n FROM x GROUP BY ALL""",
)
def stream_hourly_counts(t):
    stream = hourly.hourly_deals(stream_of(t, "hourly_leads"))
    out = hourly.drain_counts(stream, scratch_path(t.spark, "hourly-deals"))
    return out.withColumn("local_date", F.col("local_date").cast("string"))


@query(
    "stream_first_qualification",
    """SELECT country, deal_id, epoch_us(min(ts)) AS event_us FROM v_hourly_log
    WHERE deal_id IS NOT NULL AND state_id IN (20, 63) GROUP BY ALL""",
)
def stream_first_qualification(t):
    stream = hourly.qualifications(stream_of(t, "hourly_log"))
    first = hourly.drain_first(stream, scratch_path(t.spark, "qualifications"))
    return first.select("country", "deal_id", F.expr(unix_micros_sql("event_ts", first.schema["event_ts"].dataType)).alias("event_us"))
