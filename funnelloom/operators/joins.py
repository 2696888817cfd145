"""Joins that stay balanced when a key is NULL or very frequent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _filler(df: DataFrame, key: str) -> Column:
    """Per-row stand-in for a NULL key. It depends on the row alone, so a recomputed
    task places its rows as before."""
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    if dict(df.dtypes)[key] == "string":
        return F.concat(F.lit("\u0000"), spread.cast("string"))
    return spread


def left_join_spread(left: DataFrame, *rights: DataFrame, on: Sequence[str], nullable: str) -> DataFrame:
    """Left joins on ``on`` in which rows with a NULL ``nullable`` key do not all meet
    in one task. Several right sides share one placement of the left rows.

    Such rows match nothing. They get a hashed stand-in key for the shuffle only;
    the extra condition keeps the stand-in from ever matching. Frequent non-NULL
    keys of the left side are left to AQE, which can split them because the right
    side is not duplicated by that.
    """
    out = left.withColumn("__key", F.coalesce(F.col(nullable), _filler(left, nullable)))
    for right in rights:
        renamed = right.select(
            *[F.col(k).alias(f"__r_{k}") for k in on],
            *[F.col(c) for c in right.columns if c not in on],
        )
        test = F.col(nullable).isNotNull()
        for k in on:
            mine = F.col("__key" if k == nullable else k)
            test = test & (mine == F.col(f"__r_{k}"))
        out = out.join(renamed, test, "left").drop(*[f"__r_{k}" for k in on])
    return out.drop("__key")


def anti_join(left: DataFrame, right: DataFrame, on: Sequence[str], nullable: str) -> DataFrame:
    """Rows of ``left`` without partner; NULL-keyed rows are kept and spread."""
    keys = right.select(*on).distinct().withColumn("__hit", F.lit(True))
    return left_join_spread(left, keys, on=on, nullable=nullable).where(F.col("__hit").isNull()).drop("__hit")


def fan_out_counts(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    out: str = "n",
) -> DataFrame:
    """Row count of the inner join of two tables that both repeat their key, per
    (left keys, right keys), without forming the pairs.

    Each side is counted per join key first; a key with a and b rows contributes
    a * b from one joined row, so a key that holds much of both tables costs no more
    than any other.
    """
    keyed = F.col(on[-1]).isNotNull()
    a = left.where(keyed).groupBy(*dict.fromkeys([*on, *left_keys])).agg(F.count("*").alias("__a"))
    b = right.where(keyed).groupBy(*dict.fromkeys([*on, *right_keys])).agg(F.count("*").alias("__b"))
    return (
        a.join(b, list(on))
        .groupBy(*left_keys, *right_keys)
        .agg(F.sum(F.col("__a") * F.col("__b")).alias(out))
    )


def assemble_metrics(frames: Sequence[DataFrame], keys: Sequence[str], counts: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """Metric tables of one key set side by side.

    One union and one grouping stand for the distinct union of the keys and a left
    join per metric. As in that form, a key with a NULL part exists as a row but
    matches no metric: its counts are 0 and its sums NULL.
    """
    stacked = None
    for df in frames:
        stacked = df if stacked is None else stacked.unionByName(df, allowMissingColumns=True)
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    grouped = stacked.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in (*counts, *sums) if c in stacked.columns]
    )
    return grouped.select(
        *keys,
        *[F.when(whole, F.coalesce(F.col(c), F.lit(0))).otherwise(0).cast("long").alias(c) for c in counts],
        *[F.when(whole, F.col(c)).alias(c) for c in sums],
    )


def union_tagged(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    """Stack tables of different shape; missing columns become typed NULLs."""
    out = None
    for name, df in frames.items():
        one = df.withColumn(tag, F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def parity_full_outer(left: DataFrame, right: DataFrame, on: Sequence[str], a: str, b: str) -> DataFrame:
    """Two counts per key with their difference; NULL where one side is absent."""
    return left.join(right, list(on), "full_outer").withColumn("diff", F.col(a) - F.col(b))


def semi_in_latest(df: DataFrame, bucket: str, n: int) -> DataFrame:
    """Rows whose bucket is among the latest ``n`` distinct buckets of the table.

    The n values form a table of at most n rows; that bound is what allows the
    broadcast.
    """
    top = df.select(bucket).where(F.col(bucket).isNotNull()).distinct().orderBy(F.desc(bucket)).limit(n)
    return df.join(F.broadcast(top), bucket, "left_semi")
