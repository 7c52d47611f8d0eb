"""Joins of spans of time (or of numbers) that meet, binned by the data.

Each key gets bins of its own on the axis: as many as its rows ask for, fewer where long spans
would be copied too often. A row goes to every bin that its span touches, the two sides meet on
key and bin, and a pair is kept in the first bin that both touch, so it comes once. An instant
is a span of one point and lies in one bin. The left rows of a key whose bins stay full (many
readings under a few long spans) are dealt over salts, and the right ones copied to each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.joins import join_small, salt_hash
from stratalake.session import scratch_path, shuffle_width

#: Rows of the longer side that meet in one bin, and copies of a row on average, by which bins are sized.
ROWS_PER_BIN, MEAN_COPIES = 8, 4
#: A key gets no more bins than this; its copies of one row are bounded by it, too.
MOST_BINS = 1_000_000
#: Left rows that one bin may expect before they are dealt over salts; more in a large table.
LEAST_SHARE = 100_000

AXIS = ("__lo", "__hi")


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_span: tuple[Column, Column],
    right_span: tuple[Column, Column],
    condition: Column | None = None,
    rows_per_bin: int = ROWS_PER_BIN,
    least_share: int = LEAST_SHARE,
) -> DataFrame:
    """All pairs with equal keys whose closed spans share a point, and that fulfil `condition`.

    A span is a pair of columns (from, to) of dates, timestamps or finite numbers, of one kind on both
    sides. A null at the left end: the row pairs with nothing; a null at the right end: the span never ends. A span
    that ends before it begins and rows without a key pair with nothing. All columns of both sides are
    returned, the keys once; other names may not clash. Without keys all rows are one key.

    One pass over keys and spans of each side sizes the bins; its result, a row per key, is stored.
    """
    clash = sorted({c.lower() for c in left.columns} & {c.lower() for c in right.columns} - {c.lower() for c in on})
    if clash:
        raise ValueError(f"both sides have {clash}: rename them on one side")
    out = [F.col(f"`{c}`") for c in [*left.columns, *[c for c in right.columns if c not in on]]]
    keys = list(on) or ["__all"]
    place = _axis([*_kinds(left, left_span), *_kinds(right, right_span)])
    a, b = _on_axis(left, left_span, keys, place), _on_axis(right, right_span, keys, place)
    bins = _bins(_facts(a, keys, "a"), _facts(b, keys, "b"), keys, rows_per_bin, least_share)
    comparable = left.select(*[f"`{f.name}`" for f in left.schema if "map<" not in f.dataType.simpleString()])
    a = _spread(a, bins, keys, "a").withColumn("__salt", F.pmod(salt_hash(comparable), F.col("__salts")).cast("int"))
    b = _spread(b, bins, keys, "b").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)))
    pairs = a.drop("__salts").join(b.drop("__salts"), [*keys, "__bin", "__salt"])
    once = F.col("__bin") == F.greatest("__a_first", "__b_first")
    meets = (F.col("__a_lo") <= F.col("__b_hi")) & (F.col("__b_lo") <= F.col("__a_hi"))
    pairs = pairs.where(once & meets)
    return (pairs if condition is None else pairs.where(condition)).select(*out)


def _kinds(df: DataFrame, span: tuple[Column, Column]) -> list[T.DataType]:
    return [f.dataType for f in df.select(span[0].alias("a"), span[1].alias("b")).schema]


def _axis(kinds: list[T.DataType]) -> tuple[Callable[[Column], Column], Column]:
    """How an end becomes a number that grows with it, and the number of an end that never comes."""
    if any(isinstance(k, (T.TimestampType, T.TimestampNTZType)) for k in kinds):
        return lambda c: F.unix_micros(c.cast("timestamp")), F.lit(2**63 - 1)
    if any(isinstance(k, T.DateType) for k in kinds):
        return lambda c: F.unix_date(c).cast("bigint"), F.lit(2**63 - 1)
    if all(isinstance(k, T.IntegralType) for k in kinds):
        return lambda c: c.cast("bigint"), F.lit(2**63 - 1)
    return lambda c: c.cast("double"), F.lit(float("inf"))


def _on_axis(df: DataFrame, span: tuple[Column, Column], keys: list[str], axis) -> DataFrame:
    place, never = axis
    low, high = place(span[0]), place(span[1])
    usable = low.isNotNull() & (high.isNull() | (low <= high))
    if keys == ["__all"]:
        df = df.withColumn("__all", F.lit(0))
    for key in keys:
        usable = usable & F.col(key).isNotNull()
    return df.where(usable).withColumns({"__lo": low, "__hi": F.coalesce(high, never), "__ends": high.isNotNull()})


def _facts(df: DataFrame, keys: list[str], side: str) -> DataFrame:
    """Per key: rows, reach and summed length, open ends apart. Pre-aggregated before the shuffle."""
    lo, hi = (F.col(c).cast("double") for c in AXIS)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(f"{side}_n"),
        F.min(lo).alias(f"{side}_lo"),
        F.greatest(F.max(lo), F.max(F.when(F.col("__ends"), hi))).alias(f"{side}_hi"),
        F.coalesce(F.sum(F.when(F.col("__ends"), hi - lo)), F.lit(0.0)).alias(f"{side}_closed"),
        F.coalesce(F.sum(F.when(~F.col("__ends"), lo)), F.lit(0.0)).alias(f"{side}_open_from"),
        F.count_if(~F.col("__ends")).alias(f"{side}_open"),
    )


def _bins(a: DataFrame, b: DataFrame, keys: list[str], rows_per_bin: int, least_share: int) -> DataFrame:
    """(key, __from, __width, __bins, __salts) of the keys that both sides have, stored once."""
    low, high = F.least("a_lo", "b_lo"), F.greatest("a_hi", "b_hi")
    limits = []
    for s in "ab":  # bins by which the mean row has at most MEAN_COPIES copies beyond its first
        length = F.col(f"{s}_closed") + F.col(f"{s}_open") * high - F.col(f"{s}_open_from")
        limits.append(F.when(length > 0, MEAN_COPIES * (high - low) * F.col(f"{s}_n") / length))
    wanted = F.least(F.greatest("a_n", "b_n") / rows_per_bin, F.lit(float(MOST_BINS)), *limits)  # passes nulls over
    found = a.join(b, keys).withColumn("__bins", F.greatest(F.ceil(wanted), F.lit(1)).cast("bigint"))
    found = found.select(*keys, "a_n", low.alias("__from"), ((high - low) / F.col("__bins")).alias("__width"), "__bins")
    spark, path = found.sparkSession, scratch_path(found.sparkSession, "bins")
    found.write.parquet(path)
    bins = spark.read.schema(found.schema).parquet(path)
    rows = bins.agg(F.sum("a_n")).first()[0] or 0
    share = max(least_share, rows // (4 * shuffle_width(spark)))
    salts = F.ceil(F.col("a_n") / F.col("__bins") / share).cast("int")
    return bins.select(*keys, "__from", "__width", "__bins", salts.alias("__salts"))


def _spread(df: DataFrame, bins: DataFrame, keys: list[str], side: str) -> DataFrame:
    """A row per bin that the span touches."""

    def bin_of(c: str) -> Column:
        # never falls as the place grows, so spans that share a point share a bin
        no = (F.col(c).cast("double") - F.col("__from")) / F.col("__width")
        inside = F.least(F.greatest(no, F.lit(0.0)), (F.col("__bins") - 1).cast("double"))
        return F.when(F.col("__width") > 0, F.floor(inside)).otherwise(F.lit(0)).cast("bigint")

    marked = join_small(df, bins, keys).withColumns({f"__{side}_first": bin_of("__lo"), "__last": bin_of("__hi")})
    return (
        marked.withColumn("__bin", F.explode(F.sequence(F.col(f"__{side}_first"), F.col("__last"))))
        .withColumnsRenamed({"__lo": f"__{side}_lo", "__hi": f"__{side}_hi"})
        .drop("__from", "__width", "__bins", "__last", "__ends")
    )


def validity_join(
    usage: DataFrame,
    prices: DataFrame,
    on: list[str],
    at: Column,
    start: Column,
    end: Column,
    ends_before: Column | None = None,
    rows_per_bin: int = ROWS_PER_BIN,
    least_share: int = LEAST_SHARE,
) -> DataFrame:
    """Match each usage row with the price valid for it.

    Condition: `start <= at` and (`end` is NULL or the usage ends in time). By default the
    interval is half open (`at < end`); pass `ends_before` for the closed form, which tests
    `ends_before <= end`. Prices that end before they begin match only a usage that does so, too.
    """
    in_time = (at < end) if ends_before is None else (ends_before <= end)
    # a price that holds reaches from `at` back to `ends_before` where a usage ends before it begins
    first = at if ends_before is None else F.least(at, ends_before)
    until = F.when(end.isNull() | (end >= start), end).otherwise(start)
    return overlap_join(
        usage, prices, on, (first, at), (F.least(start, end), until), end.isNull() | in_time, rows_per_bin, least_share
    ).where(start <= at)
