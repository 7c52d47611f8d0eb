"""Splitting ordered data into ranges with fixed bounds, and global numbering on top.

A window without PARTITION BY, or one whose key holds a third of the table, runs in one
task. Here the sort key is cut at sampled bounds; the bounds are frozen as literals, so
the range of a row is a pure function of the row and a retried task puts it in the same
range again.
"""

from __future__ import annotations

import json
import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.session import scratch_path, shuffle_width

SAMPLE_PER_RANGE = 50
RANGES_PER_TASK = 3
#: A table gets no more ranges than it has this many rows, and no fewer than one per so many.
ROWS_PER_RANGE, MOST_ROWS_PER_RANGE = 50_000, 5_000_000
#: Bounds kept as literals are no more than this, whatever the size of the table, so the driver sees at most
#: 1.2 * SAMPLE_PER_RANGE * MOST_RANGES keys. A table that asks for more ranges is numbered in files.
MOST_RANGES = 2_000


def _cuts(df: DataFrame, cols: list[str], ranges: int, rows: int | None = None) -> list[tuple]:
    """`ranges - 1` ascending sort-key values at even places of a sample; a key that is more
    frequent than a range comes several times.

    The driver receives about SAMPLE_PER_RANGE keys per range, for MOST_RANGES ranges at most,
    whatever the size of the table.
    """
    ranges = min(ranges, MOST_RANGES)
    keys = df.select(*cols)
    total = keys.count() if rows is None else rows
    want = SAMPLE_PER_RANGE * ranges
    if ranges < 2 or total == 0:
        return []
    sample = keys.sample(fraction=1.2 * want / total, seed=17) if total > 2 * want else keys
    picked = sample.orderBy(*cols).collect()
    places = sorted({len(picked) * i // ranges for i in range(1, ranges)})
    return [tuple(picked[i]) for i in places if i < len(picked)]


def sample_bounds(df: DataFrame, cols: list[str], ranges: int, rows: int | None = None) -> list[tuple]:
    """At most `ranges - 1` different sort-key values that cut `df` into similar parts. Any
    bounds give right results; only the balance depends on them."""
    return list(dict.fromkeys(_cuts(df, cols, ranges, rows)))


def _wanted_ranges(df: DataFrame, ranges: int | None) -> tuple[int, int]:
    """Number of ranges and of rows: by default a few ranges per shuffle task, so that unequal
    ranges even out, more for a table whose ranges would get too long, and none for one that a
    task numbers at once."""
    rows = df.count()
    if ranges is not None:
        return ranges, rows
    few = min(RANGES_PER_TASK * shuffle_width(df.sparkSession), -(-rows // ROWS_PER_RANGE))
    return max(few, -(-rows // MOST_ROWS_PER_RANGE)), rows


def range_of(df: DataFrame, cols: list[str], bounds: list[tuple]) -> Column:
    """Number of bounds below the row's key: 0 .. len(bounds).

    Looked up in two steps (block, then position in the block), about 2*sqrt(n)
    comparisons a row, inside the JVM. The result never falls as the key grows, whatever
    the bounds are.
    """
    if not bounds:
        return F.lit(0)
    if len(cols) == 1:  # plain values compare faster than one-field structs
        key, key_type = F.col(cols[0]), df.schema[cols[0]].dataType
        values = [b[0] for b in bounds]
    else:
        key = F.struct(*[F.col(c) for c in cols])
        key_type = T.StructType([T.StructField(c, df.schema[c].dataType) for c in cols])
        values = [dict(zip(cols, b)) for b in bounds]

    def constant(value, kind: T.DataType) -> Column:
        # one folded literal, however many bounds there are
        return F.from_json(F.lit(json.dumps(value, default=_as_json)), kind)

    width = max(1, math.isqrt(len(bounds)))
    blocks = [values[i : i + width] for i in range(0, len(values), width)]
    tops = constant([block[-1] for block in blocks], T.ArrayType(key_type))
    table = constant(blocks, T.ArrayType(T.ArrayType(key_type)))

    def below(candidates: Column, k: Column) -> Column:
        return F.size(F.filter(candidates, lambda b: b < k))

    def position(k: Column) -> Column:
        # the block number is bound by a lambda so that it is found once per row
        in_block = F.transform(
            F.array(below(tops, k)), lambda no: no * width + F.coalesce(below(F.get(table, no), k), F.lit(0))
        )
        return F.least(F.get(in_block, 0), F.lit(len(bounds)))

    # never NULL, so that a join on the range infers no filter that looks it up again
    return F.coalesce(F.get(F.transform(F.array(key), position), 0), F.lit(0))


def _as_json(value):
    return float(value) if isinstance(value, Decimal) else value.isoformat()


def add_row_number(df: DataFrame, order: list[str], out: str, ranges: int | None = None) -> DataFrame:
    """Global `row_number() over (order by order)` as BIGINT, without a one-task window.

    Rows are numbered inside each range; the start of a range is the running count of the
    ranges before it, a table of one row per range. Rows of a key that fills more than a range
    are cut further by a hash of the row, which settles their order. A table that asks for more
    than MOST_RANGES ranges is numbered by its place in sorted files.
    """
    wanted, rows = _wanted_ranges(df.select(*order), ranges)
    if wanted > MOST_RANGES:
        return numbered_in_files(df, order, out, wanted)
    cuts = _cuts(df, order, wanted, rows)
    if not cuts:
        return df.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    if len(set(cuts)) == len(cuts):
        return _numbered(df.withColumn("__range", range_of(df, order, cuts)), order, out, F.row_number())
    tied = df.withColumn("__tie", F.xxhash64(*[F.col(c) for c in df.columns]))
    by = [*order, "__tie"]
    bounds = sample_bounds(tied, by, wanted, rows)
    return _numbered(tied.withColumn("__range", range_of(tied, by, bounds)), by, out, F.row_number()).drop("__tie")


def numbered_in_files(df: DataFrame, order: list[str], out: str, files: int) -> DataFrame:
    """`add_row_number` for tables of any length: the rows are stored once in the shared folder, a
    sorted range per file, and a row's number is its place in its file behind the rows of the files before.

    Spark draws the bounds (at most a million sampled keys, whatever the number of files); rows of one
    key are dealt over files by a hash. What is stored does not move, so a retried task reads the
    same numbers. The counts, a row per file, are added up in one task.
    """
    spark, path, tie = df.sparkSession, scratch_path(df.sparkSession, "numbered"), "__tie"
    tied = df.withColumn(tie, F.xxhash64(*[F.col(c) for c in df.columns]))
    by = [*order, tie]
    tied.repartitionByRange(files, *by).sortWithinPartitions(*by).write.option("maxRecordsPerFile", 0).parquet(path)
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)-", 1).cast("int")
    stored = spark.read.schema(tied.schema).parquet(path)
    placed = stored.select(*df.columns, part.alias("__file"), F.col("_metadata.row_index").alias("__place"))
    sizes = stored.groupBy(part.alias("__file")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    numbered = placed.join(F.broadcast(starts), "__file")  # one row per file
    return numbered.select(*df.columns, (F.col("__start") + F.col("__place") + 1).alias(out))


def _numbered(cut: DataFrame, order: list[str], out: str, number: Column, count_first: bool = True) -> DataFrame:
    """Numbers inside the ranges plus the highest numbers of the ranges before: one exchange by
    range, which both sides of the closing join read."""
    part, inner, start, n = "__range", "__inner", "__start", "__n"
    inside = cut.withColumn(inner, number.over(Window.partitionBy(part).orderBy(*order)))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    if count_first:  # countable before the exchange
        sizes = cut.groupBy(part).agg(F.count(F.lit(1)).alias(n))
    else:
        sizes = inside.groupBy(part).agg(F.max(inner).alias(n))
    starts = sizes.select(part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start))
    return (
        # one row per range, and one for every row: a left join, which Spark leaves out where nobody reads the number
        inside.join(F.broadcast(starts), part, "left")
        .withColumn(out, (F.col(inner) + F.col(start)).cast("bigint"))
        .drop(part, inner, start)
    )


def add_dense_rank(
    df: DataFrame, order: list[str], out: str, ranges: int | None = None, bounds_from: DataFrame | None = None
) -> DataFrame:
    """Global `dense_rank() over (order by order)`.

    The range is a function of the key, so all copies of a key are in one range and are ranked
    there. If the sample shows a key that fills more than a range, or the table asks for more than
    MOST_RANGES ranges, the distinct keys are numbered and joined back instead, so that the
    copies of a key never gather in one task.

    `bounds_from` is a cheaper table with the same order columns to sample the bounds from.
    """
    source = df if bounds_from is None else bounds_from
    wanted, rows = _wanted_ranges(source.select(*order), ranges)
    cuts = _cuts(source, order, wanted, rows) if wanted <= MOST_RANGES else []
    bounds = list(dict.fromkeys(cuts))
    if wanted <= MOST_RANGES and len(bounds) == len(cuts):
        ranked = _numbered(df.withColumn("__range", range_of(df, order, bounds)), order, out, F.dense_rank(), count_first=False)
        return ranked.select(*df.columns, out)
    unique = df.select(*order).distinct()
    if wanted <= MOST_RANGES:
        keys = _numbered(unique.withColumn("__range", range_of(unique, order, bounds)), order, out, F.row_number())
    else:
        keys = numbered_in_files(unique, order, out, wanted)
    renamed = keys.select(*[F.col(c).alias(f"__k_{c}") for c in order], out)
    match = [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in order]
    joined = df.join(renamed, match, "inner")
    return joined.drop(*[f"__k_{c}" for c in order])
