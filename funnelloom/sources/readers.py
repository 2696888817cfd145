"""Reading stored result rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load_result_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON result rows whose numbers are text, cast to ``schema`` (a DDL string).

    Whole-number columns accept ``12`` and ``12.0`` and drop the fraction towards zero;
    a missing value stays NULL.
    """
    target = T.StructType.fromDDL(schema)
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in target.fields])
    rows = spark.read.schema(as_text).json(path)

    def typed(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, (T.LongType, T.IntegerType)):
            # A decimal keeps all digits of a BIGINT; casting it on drops the fraction.
            value = value.cast("decimal(38,10)")
        return value.cast(field.dataType).alias(field.name)

    return rows.select(*[typed(f) for f in target.fields])
