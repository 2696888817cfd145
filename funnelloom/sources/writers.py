"""Nested result documents and their JSON form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nested_by_day(daily: DataFrame) -> DataFrame:
    """One document per country and day: channel to its three metrics.

    A campaign without a dictionary row is a channel of its own, so what bounds a
    document is the number of different campaign texts of its day. Where that text is
    open-ended, ``write_flat`` stores the same cells as rows.
    """
    cell = F.struct(F.coalesce("channel", F.lit("null")).alias("channel"), "reg", "cal", "spend")
    return (
        daily.groupBy("country", F.col("dia").cast("string").alias("dia"))
        .agg(F.sort_array(F.collect_list(cell)).alias("cells"))
        .select(
            "country",
            "dia",
            F.map_from_entries(
                F.transform(
                    "cells",
                    lambda c: F.struct(
                        c["channel"].alias("key"),
                        F.struct(c["reg"].alias("reg"), c["cal"].alias("cal"), c["spend"].alias("spend")).alias(
                            "value"
                        ),
                    ),
                )
            ).alias("by_channel"),
        )
    )


def write_json(df: DataFrame, path: str) -> None:
    """NULL metrics are written, since NULL and 0 differ."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_flat(daily: DataFrame, path: str) -> None:
    """One row per country, day and channel, in a folder per country and day."""
    daily.write.mode("overwrite").partitionBy("country", "dia").parquet(path)


def round_trip_json(df: DataFrame) -> DataFrame:
    """Documents as their JSON text and parsed again with their schema: what a reader of
    ``write_json``'s files gets, without a store in between."""
    text = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(F.from_json(text, df.schema).alias("doc")).select("doc.*")


def ordered_json(column: str) -> Column:
    """A map column as JSON text with its keys in order."""
    ordered = F.map_from_entries(F.array_sort(F.map_entries(column)))
    return F.to_json(ordered, {"ignoreNullFields": "false"})
