"""Finding skewed keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_counts(df: DataFrame, key: str, out: str = "order_count") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def top_keys(df: DataFrame, key: str, k: int = 10, out: str = "order_count") -> DataFrame:
    """The k most frequent keys; ties broken by the key."""
    return key_counts(df, key, out).orderBy(F.desc(out), F.asc(key)).limit(k)


def skew_report(df: DataFrame, key: str, limit: float = 10.0) -> DataFrame:
    """One row: max, average and p95 rows per key, their ratio, and a flag."""
    counts = key_counts(df, key, "n")
    ratio = F.try_divide(F.col("max_count"), F.col("avg_count"))
    return counts.agg(
        F.max("n").alias("max_count"),
        F.avg("n").alias("avg_count"),
        F.percentile_approx("n", 0.95, 10_000).alias("p95_count"),
    ).select(
        "*",
        F.coalesce(ratio, F.lit(0.0)).alias("skew_ratio"),
        F.coalesce(ratio > limit, F.lit(False)).alias("is_skewed"),
    )
