"""Shared by the operators: the sample tables, the cluster's shared folder, column choice."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # Python workers must find this package: its place goes to them with every function.
    # A cluster that has it elsewhere (installed, or from --py-files) is not disturbed.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that the driver and all executors see.

    ``spark.checkpoint.dir`` names it on a cluster. Where that is unset (tests), the
    folder lies in the warehouse, which a cluster shares as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str, codec: str = "zstd") -> DataFrame:
    """The rows written to the shared folder and read again: computed once, lineage cut."""
    spark = df.sparkSession
    path = shared_path(spark, purpose)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
