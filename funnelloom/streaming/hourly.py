"""The hourly board as streams: hourly counts and first qualifications.

Both jobs drain what is available and stop, so a scheduler can run them as often as the
board is to be refreshed. The caller names the folder that holds progress and results;
a later run with the same folder reads new files only and adds to the same results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelloom.functions.text import label_source
from funnelloom.operators.channels import per_country
from funnelloom.spec import LABELS_HOURLY, QUALIFIED_MM
from funnelloom.streaming.runs import MergedRuns

LATENESS = "2 hours"
HOUR = ("country", "local_date", "hour", "source")
DEAL = ("country", "deal_id")


def hourly_deals(leads: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Each deal once per country, local hour and source over a stream of leads.

    The state holds the keys of the hours that the watermark has not passed; rows that
    come later than that are dropped. A watermark needs an instant, so the zoneless
    time is cast first; the offset turns it into local time before the hours are cut.
    """
    local = per_country(
        lambda s: F.col("created_at").cast("timestamp") + F.make_dt_interval(hours=F.lit(s.utc_offset))
    )
    rows = (
        leads.where(F.col("deal_id").isNotNull() & F.col("source_id").isin(*LABELS_HOURLY))
        .withColumn("local_ts", local)
        .withColumn("source", label_source(F.col("source_id"), LABELS_HOURLY))
        .withWatermark("local_ts", lateness)
        .select(*DEAL, "source", F.window("local_ts", "1 hour").alias("window"))
    )
    return rows.dropDuplicates([*DEAL, "source", "window"]).select(
        *DEAL,
        F.to_date("window.start").alias("local_date"),
        (F.hour("window.start") + 1).alias("hour"),
        "source",
    )


def hourly_counts(deals: DataFrame) -> DataFrame:
    """Distinct deals per country, local hour and source of rows that have each once."""
    return deals.groupBy(*HOUR).agg(F.count("*").alias("n"))


def qualifications(log: DataFrame) -> DataFrame:
    """Qualifying rows of a stream of the log with their event time."""
    rows = log.where(F.col("deal_id").isNotNull() & F.col("state_id").isin(*QUALIFIED_MM))
    return rows.select(*DEAL, F.col("ts").alias("event_ts"))


def first_per_deal(rows: DataFrame) -> DataFrame:
    """Earliest event per deal. The minimum of minima is the minimum, so it is taken in
    each batch and once more over what the batches left: exact for rows in any order,
    late ones included, and nothing is kept in a state store."""
    return rows.groupBy(*DEAL).agg(F.min("event_ts").alias("event_ts"))


def drain_counts(deals: DataFrame, folder: str) -> DataFrame:
    """Hourly counts of all batches so far. The stream's state lets a deal through once per
    hour and source, so the batches' counts add up; deals themselves are not stored."""
    return _drain(deals, folder, hourly_counts, HOUR, {"n": F.sum})


def drain_first(log: DataFrame, folder: str) -> DataFrame:
    """First qualification per deal of all batches so far, one stored row or two per deal."""
    return _drain(log, folder, first_per_deal, DEAL, {"event_ts": F.min})


def _drain(
    stream: DataFrame, folder: str, per_batch: Callable[[DataFrame], DataFrame], keys: tuple[str, ...],
    merge: dict[str, Callable[[str], Column]],
) -> DataFrame:
    """Run a stream over all available input, merge its batches into the stored result and
    return that."""
    spark, base = stream.sparkSession, folder.rstrip("/")
    empty = spark.createDataFrame([], stream.schema)
    table = MergedRuns(spark, f"{base}/runs", per_batch(empty).schema, keys, merge)
    writer = stream.writeStream.foreachBatch(lambda batch, number: table.add(per_batch(batch), number)).outputMode("append")
    writer.option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start().awaitTermination()
    return table.read()
