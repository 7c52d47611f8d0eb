"""Joins with a checked broadcast, salting for hot keys, and price-validity matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.ranges import range_of, sample_bounds
from stratalake.session import shuffle_width

BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 2_000_000


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES, max_rows: int = BROADCAST_ROWS) -> bool:
    """Measured, not guessed: first the row count, then, only for few rows, their size."""
    if df.count() > max_rows:
        return False
    row_bytes = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    return (df.agg(F.sum(row_bytes)).first()[0] or 0) <= max_bytes


def join_small(fact: DataFrame, dim: DataFrame, on, how: str = "inner", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast join when the dimension is measured to be small; otherwise a shuffled
    join whose hot partitions adaptive execution splits."""
    return fact.join(F.broadcast(dim) if fits_broadcast(dim, max_bytes) else dim, on, how)


def salt_hash(df: DataFrame) -> Column:
    """A number that does not depend on row order, so a retried task repeats it, and that
    differs between identical rows read by different tasks."""
    return F.xxhash64(*[F.col(c) for c in df.columns], F.spark_partition_id())


def salt_of(df: DataFrame, salts: int) -> Column:
    return F.pmod(salt_hash(df), F.lit(salts)).cast("int")


def hot_keys(df: DataFrame, keys: list[str], more_than: int) -> DataFrame:
    """Keys with more than `more_than` rows: at most rows/more_than of them."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > more_than)


def join_salted_selective(
    fact: DataFrame, dim: DataFrame, key: str, more_than: int | None = None, salts: int | None = None
) -> DataFrame:
    """Inner join where only the hot keys are salted.

    A key is hot with more than `more_than` rows; by default with more than a quarter of an
    average shuffle task's share, so there are at most four hot keys per task. Each hot key
    gets as many salts as it has multiples of that limit (or the fixed number `salts`), so
    no salt holds much more than the limit however hot the key is.

    The hot list carries the number of salts, so a fact row is hot exactly when the list has
    its key. Hot dimension rows are replicated once per salt, the others keep salt 0.
    """
    if more_than is None:
        more_than = max(1000, fact.count() // (4 * shuffle_width(fact.sparkSession)))
    wanted = F.ceil(F.col("cnt") / more_than).cast("int") if salts is None else F.lit(salts)
    hot = hot_keys(fact, [key], more_than).select(key, wanted.alias("__salts"))
    hot = F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot
    salted_fact = (
        fact.withColumn("__hash", salt_hash(fact))
        .join(hot, key, "left")
        .withColumn("__salt", F.when(F.col("__salts").isNull(), 0).otherwise(F.pmod("__hash", "__salts")).cast("int"))
        .drop("__salts", "__hash")
    )
    salted_dim = (
        dim.join(hot, key, "left")
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)))
        .drop("__salts")
    )
    return salted_fact.join(salted_dim, [key, "__salt"], "inner").drop("__salt")


def join_salted_full(fact: DataFrame, dim: DataFrame, key: str, salts: int | None = None, how: str = "left") -> DataFrame:
    """Every key salted, each with as many salts as its rows ask for: a key gets one more for each
    share of the fact, a quarter of an average shuffle task's. All keys together get four salts
    a task beyond their first, whatever the skew, and a dimension row is copied once per salt of its own
    key. With a fixed number `salts` every key gets that many."""
    if salts is None:
        sizes = fact.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
        share = max(1000, fact.count() // (4 * shuffle_width(fact.sparkSession)))
        more = sizes.where(F.col("__n") > share).select(key, F.ceil(F.col("__n") / share).cast("int").alias("__salts"))
        fact, dim = join_small(fact, more, key, "left"), join_small(dim, more, key, "left")
        salts_of = F.coalesce(F.col("__salts"), F.lit(1))
    else:
        salts_of = F.lit(salts)
    salted_fact = fact.withColumn("__salt", F.pmod(salt_hash(fact), salts_of).cast("int")).drop("__salts")
    salted_dim = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0), salts_of - 1))).drop("__salts")
    return salted_fact.join(salted_dim, [key, "__salt"], how).drop("__salt")


def replicate(dim: DataFrame, salts: int, out: str = "salt_val") -> DataFrame:
    """Each dimension row once per salt value (the product with a generated list)."""
    return dim.withColumn(out, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))


def overlapping_validity(prices: DataFrame, on: list[str], start: str, end: str, hot_rows: int = 5_000_000) -> DataFrame:
    """Price rows that begin before an earlier one of the same product ended: each of them
    would be counted twice by `validity_join`.

    A sweep in order of the start with the latest end so far. A product with more than `hot_rows`
    rows is cut into ranges of the start; a range begins with the latest end of those before it."""
    ends = F.coalesce(F.col(end), F.lit("9999-12-31").cast("timestamp"))
    hot = hot_keys(prices, on, hot_rows)
    columns, by = prices.columns, list(on)
    if not hot.isEmpty():
        marked = join_small(prices, hot.select(*on, F.lit(True).alias("__hot")), on, "left")
        big = marked.where("__hot")
        n = big.count()
        bounds = sample_bounds(big, [start], 2 + 4 * n // hot_rows, n)
        # a NULL start, first in order, lies in the first range
        prices = marked.withColumn("__r", F.when(F.col("__hot"), F.coalesce(range_of(marked, [start], bounds), F.lit(0))).otherwise(F.lit(0)))
        by = [*on, "__r"]
    w = Window.partitionBy(*by).orderBy(start)
    reach = F.max(ends).over(w.rowsBetween(Window.unboundedPreceding, -1))
    swept = prices.withColumn("__reach", reach)
    if by != list(on):
        before = Window.partitionBy(*on).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
        latest = prices.where("__hot").groupBy(*by).agg(F.max(ends).alias("__end"))
        carry = latest.select(*by, F.max("__end").over(before).alias("__before"))
        swept = join_small(swept, carry, by, "left").withColumn("__reach", F.greatest("__reach", "__before"))
    return swept.where(F.col(start) < F.col("__reach")).select(*columns)
