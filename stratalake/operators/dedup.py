"""Keeping the newest row, or the newest load, per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """One row per key: the first under `newest_first`.

    The optimizer turns the rank filter into a group limit before the shuffle, so each
    map task ships at most one row of a key, however hot the key is. Give enough order
    columns to settle ties; load stamps alone are constant within a load.
    """
    w = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def newest_batch(df: DataFrame, keys: list[str], loaded: str) -> DataFrame:
    """All rows of the newest load of each key (ties kept).

    Same rows as `dense_rank() = 1`, computed as a pre-aggregated maximum joined back, so
    a key with very many rows is split by the join instead of sorted in one task.
    """
    top = df.groupBy(*keys).agg(F.max(loaded).alias("__top"))
    top = top.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__top")
    match = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    match.append(F.col(loaded).eqNullSafe(F.col("__top")))
    return df.join(top, match, "inner").drop("__top", *[f"__k_{k}" for k in keys])


def content_order(df: DataFrame, leading: list[Column] = (), skip: tuple[str, ...] = ()) -> list[Column]:
    """`leading` followed by every other column: a total order up to identical rows."""
    return [*leading, *[F.col(c).asc_nulls_last() for c in df.columns if c not in skip]]


def drop_duplicate_keys(df: DataFrame, keys: list[str], prefer: list[Column] | None = None) -> DataFrame:
    """One row per key with a repeatable survivor (streams use the watermark variant)."""
    order = prefer if prefer is not None else content_order(df, skip=tuple(keys))
    return latest_per_key(df, keys, order)


def duplicate_keys(df: DataFrame, keys: list[str], count_name: str = "duplicate_count") -> DataFrame:
    """Keys that occur more than once; NULL keys count no rows, as COUNT(key) does."""
    counted = F.count(F.when(F.col(keys[0]).isNotNull(), 1)).alias(count_name)
    return df.groupBy(*keys).agg(counted).where(F.col(count_name) > 1)
