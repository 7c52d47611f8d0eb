"""As-of joins: to each event the newest row of another table that was valid by then.

Both sides are laid one under the other, and the newest payload is carried along each key's time
order: one exchange and one sort, no comparison of every event with every version. A key with a
large share of the rows is cut into ranges of time, more for a longer key; a range starts with what the
ranges before it end with, a row per hot key and range that is laid under the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.joins import hot_keys, join_small
from stratalake.operators.ranges import MOST_RANGES, range_of, sample_bounds
from stratalake.session import scratch_path

HOT_ROWS = 5_000_000
TIME, SIDE, TIE, SPREAD, EVENT, FOUND, RANGE, COUNT = "__t", "__side", "__tie", "__spread", "__event", "__found", "__r", "__n"
VERSION, EVENT_SIDE = 0, 1
#: Ranges that hot keys share, and how many limits a key may hold before it is cut more finely.
FEW, LONG = 16, 4


def as_of_join(
    events: DataFrame,
    versions: DataFrame,
    on: list[str],
    at: str,
    valid_from: str,
    columns: list[str],
    newest_by: list[str] | None = None,
    max_age: Column | None = None,
    strictly_before: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All rows and columns of `events`, with `columns` of the newest version of the same keys.

    A version counts from `valid_from` on, that instant included unless `strictly_before`. Of
    versions from the same instant the largest by `newest_by` counts, then by `columns`. With `max_age`, an
    interval, an older version than that is not used. Events before the first version, without a
    key or without a time get nulls; versions without a key or a start are never used.
    """
    clash = sorted({c.lower() for c in columns} & {c.lower() for c in events.columns})
    if clash:
        raise ValueError(f"both sides have {clash}: rename them in the versions")
    usable = F.col(at).isNotNull()
    known = F.col(valid_from).isNotNull()
    for key in on:
        usable, known = usable & F.col(key).isNotNull(), known & F.col(key).isNotNull()

    found = F.struct(F.col(valid_from).alias("since"), *[F.col(c) for c in columns])
    tie = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate([*(newest_by or []), *columns])])
    side = -1 if strictly_before else EVENT_SIDE  # before or after the versions of the same instant
    event_rows = events.where(usable).select(
        *on,
        F.col(at).alias(TIME),
        F.lit(side).alias(SIDE),
        F.xxhash64(*[F.col(c) for c in events.columns]).alias(SPREAD),
        F.struct(*[F.col(c) for c in events.columns]).alias(EVENT),
    )
    version_rows = versions.where(known).select(
        *on, F.col(valid_from).alias(TIME), F.lit(VERSION).alias(SIDE), F.lit(0).cast("bigint").alias(SPREAD), tie.alias(TIE), found.alias(FOUND)
    )
    both = event_rows.unionByName(version_rows, allowMissingColumns=True)
    hot = _stored(hot_keys(both, on, hot_rows).withColumnRenamed("cnt", COUNT))
    carried = _carried(both, on) if hot.isEmpty() else _carried_hot(both, hot, on, hot_rows)

    matched = carried.where(F.col(EVENT).isNotNull())
    if max_age is not None:
        young = F.col(f"{FOUND}.since") >= F.col(TIME) - max_age
        matched = matched.withColumn(FOUND, F.when(young, F.col(FOUND)))
    kinds = {f.name: f.dataType for f in versions.select(*columns).schema}
    out = matched.select(f"{EVENT}.*", *[F.col(f"{FOUND}.{c}").alias(c) for c in columns])
    never = events.where(~F.coalesce(usable, F.lit(False))).select("*", *[F.lit(None).cast(kinds[c]).alias(c) for c in columns])
    return out.unionByName(never)


def _order() -> list[Column]:
    return [F.col(c) for c in (TIME, SIDE, TIE, SPREAD)]


def _carried(both: DataFrame, keys: list[str]) -> DataFrame:
    """The newest payload up to each row, within its keys."""
    so_far = Window.partitionBy(*keys).orderBy(*_order()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn(FOUND, F.last(FOUND, ignorenulls=True).over(so_far))


def _stored(df: DataFrame) -> DataFrame:
    """The rows in the shared folder, for frames that are read several times."""
    path = scratch_path(df.sparkSession, "as-of")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _carried_hot(both: DataFrame, hot: DataFrame, on: list[str], hot_rows: int) -> DataFrame:
    rows = _stored(join_small(both, hot, on, "left"))
    cut = rows.withColumn(RANGE, _range(rows, hot, hot_rows))

    # What each range of a hot key ends with, and from it what the next ones begin with: a row before all others.
    big = cut.where(F.col(COUNT).isNotNull())
    newest = F.max_by(FOUND, F.struct(TIME, TIE))
    ends = big.where(F.col(SIDE) == VERSION).groupBy(*on, RANGE).agg(newest.alias(FOUND))
    ranges = big.select(*on, RANGE).distinct().withColumn("__first", F.lit(True))
    earlier = Window.partitionBy(*on).orderBy(RANGE).rangeBetween(Window.unboundedPreceding, -1)
    begins = ranges.unionByName(ends, allowMissingColumns=True).withColumn(FOUND, F.last(FOUND, ignorenulls=True).over(earlier))
    first = begins.where(F.col("__first") & F.col(FOUND).isNotNull()).select(*on, RANGE, F.lit(VERSION).alias(SIDE), FOUND)
    return _carried(cut.unionByName(first, allowMissingColumns=True), [*on, RANGE])


def _range(rows: DataFrame, hot: DataFrame, hot_rows: int) -> Column:
    """The range of time of a hot key's row, -1 for other keys.

    A key gets ranges by its own length: one more than it has multiples of `hot_rows`, merged from FEW common
    ones, so that many keys just over the limit are not cut into single rows. Only a key
    that is longer than LONG limits, or than LONG parts of MOST_RANGES of all hot rows, is cut at all the bounds
    that such keys ask for.
    """
    place, length = [TIME, SIDE, SPREAD], F.col(COUNT)
    n = hot.agg(F.sum(COUNT)).first()[0]
    long = LONG * max(hot_rows, n // MOST_RANGES)
    n_long = hot.where(length > long).agg(F.coalesce(F.sum(COUNT), F.lit(0))).first()[0]
    common = sample_bounds(rows.where(length <= long), place, FEW, n - n_long)
    wanted = F.least(F.lit(FEW), F.ceil(length / hot_rows) + 1)
    some = F.floor(range_of(rows, place, common) * wanted / (len(common) + 1)).cast("int")
    if n_long:
        bounds = sample_bounds(rows.where(length > long), place, 2 + 4 * n_long // hot_rows, n_long)
        some = F.when(length > long, range_of(rows, place, bounds)).otherwise(some)
    return F.when(length.isNotNull(), some).otherwise(F.lit(-1))
