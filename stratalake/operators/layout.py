"""How rows lie in partitions and files: spread statistics, compaction, clustering."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.keyed import stored_bytes
from stratalake.operators.ranges import range_of, sample_bounds
from stratalake.session import scratch_path

TARGET_FILE_BYTES = 256 * 1024 * 1024


def hash_layout(df: DataFrame, parts: int, *cols: str) -> DataFrame:
    return df.repartition(parts, *cols)


def range_layout(df: DataFrame, parts: int, *cols: str) -> DataFrame:
    return df.repartitionByRange(parts, *cols)


def partition_counts(df: DataFrame, parts: int) -> DataFrame:
    """Rows per partition, empty partitions included; rows never leave their task."""
    counts = df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n_rows"))
    all_parts = df.sparkSession.range(parts).select(F.col("id").cast("int").alias("partition"))
    return all_parts.join(counts, "partition", "left").fillna(0, ["n_rows"])


def partition_spread(df: DataFrame, parts: int) -> DataFrame:
    """One row: partitions, largest, smallest, and their difference."""
    return partition_counts(df, parts).agg(
        F.count(F.lit(1)).alias("partitions"),
        F.max("n_rows").alias("max_rows"),
        F.min("n_rows").alias("min_rows"),
        (F.max("n_rows") - F.min("n_rows")).alias("skew"),
    )


def file_stats(spark: SparkSession, path: str, *cols: str) -> DataFrame:
    """Per file: rows and the range of the given columns."""
    ranges = [f(c).alias(f"{n}_{c}") for c in cols for n, f in (("min", F.min), ("max", F.max))]
    return (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.count(F.lit(1)).alias("n_rows"), *ranges)
    )


def file_list(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file, with its size; no file is opened."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    return listing.load(path).select("path", "length")


def file_count(spark: SparkSession, path: str) -> int:
    return file_list(spark, path).count()


def table_bytes(spark: SparkSession, path: str) -> int:
    return file_list(spark, path).agg(F.sum("length")).first()[0] or 0


def files_for(spark: SparkSession, path: str, file_bytes: int = TARGET_FILE_BYTES, at_least: int = 1) -> int:
    """How many files of about `file_bytes` the table at `path` makes."""
    return max(at_least, math.ceil(table_bytes(spark, path) / file_bytes))


def compact(spark: SparkSession, source: str, target: str, file_bytes: int = TARGET_FILE_BYTES) -> int:
    """Rewrite many small files as few of about `file_bytes`; returns the file count.

    `repartition` spreads rows evenly, so no output task holds more than its share.
    """
    files = files_for(spark, source, file_bytes)
    spark.read.parquet(source).repartition(files).write.mode("overwrite").parquet(target)
    return file_count(spark, target)


def z_value(ranks: list[str], bits: int) -> Column:
    """Bits of the ranks interleaved, first rank in the lowest place."""
    z = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, rank in enumerate(ranks):
            one = F.shiftright(F.col(rank), bit).bitwiseAND(F.lit(1)).cast("bigint")
            z = z.bitwiseOR(F.shiftleft(one, bit * len(ranks) + i))
    return z


def with_hilbert(df: DataFrame, x: str, y: str, bits: int, out: str) -> DataFrame:
    """`df` with the place of its cell (x, y) of a 2**bits by 2**bits square on Hilbert's curve; neighbours on
    the curve are neighbours in the square. One projection per bit, from the highest, so that
    every value is computed once and in generated code."""
    df = df.withColumns({"__x": F.col(x).cast("bigint"), "__y": F.col(y).cast("bigint"), out: F.lit(0).cast("bigint")})
    for bit in reversed(range(bits)):
        side = 1 << bit
        right, upper = (F.col(c).bitwiseAND(F.lit(side)) > 0 for c in ("__x", "__y"))
        quadrant = F.when(right, F.when(upper, 2).otherwise(3)).otherwise(F.when(upper, 1).otherwise(0))
        # the curve inside a lower quadrant is the whole one, mirrored at a diagonal
        inner = [F.col(c).bitwiseAND(F.lit(side - 1)) for c in ("__x", "__y")]
        a, b = (F.when(right & ~upper, side - 1 - v).otherwise(v) for v in inner)
        df = df.withColumns({"__x": F.when(upper, a).otherwise(b), "__y": F.when(upper, b).otherwise(a), out: F.col(out) * 4 + quadrant})
    return df.drop("__x", "__y")


#: Ranks of a clustering column: no more than this, whatever the number of files (two columns make a
#: million cells of it), so the bounds in plan and driver are few. A cell is cut by the columns themselves.
MOST_RANKS = 1024


def cluster_bounds(df: DataFrame, cols: list[str], files: int) -> dict[str, list[tuple]]:
    """Sampled bounds by which each clustering column is ranked: four ranks per file, MOST_RANKS at most."""
    rows = df.count()
    ranks = min(MOST_RANKS, 2 ** (62 // len(cols)), max(2, 4 * files))
    return {c: sample_bounds(df, [c], ranks, rows) for c in cols}


def curve_place(df: DataFrame, bounds: dict[str, list[tuple]], out: str) -> DataFrame:
    """`df` with each row's place on the curve through the cells of the ranks: Hilbert's for two columns,
    bits interleaved for more."""
    bits = max(1, max(len(b) for b in bounds.values()).bit_length())
    ranks = {f"__r{i}": range_of(df, [c], b) for i, (c, b) in enumerate(bounds.items())}
    names = list(ranks)
    ranked = df.withColumns(ranks)
    if len(names) == 2:
        return with_hilbert(ranked, *names, bits, out).drop(*names)
    return ranked.withColumn(out, z_value(names, bits)).drop(*names)


def cluster(df: DataFrame, cols: list[str], files: int) -> DataFrame:
    """Rows arranged so that each file covers a small range of every clustering column.

    The table is range-partitioned on the place on a curve through the columns' ranks plus the columns
    themselves, so a value that fills many files is cut by the other columns.
    """
    placed = curve_place(df, cluster_bounds(df, cols, files), "__z")
    return placed.repartitionByRange(files, "__z", *cols).sortWithinPartitions("__z", *cols).drop("__z")


def compact_partition(
    spark: SparkSession, path: str, column: str, value, sort_by: list[str], staging: str | None = None
) -> None:
    """Rewrite one partition of a partitioned table in sorted, fewer files.

    The new files are staged first and the partition is then replaced from the staged copy;
    the other partitions are not read. A run that dies in the swap leaves the staged copy.
    """
    staging = staging or scratch_path(spark, "compact")
    rows = spark.read.parquet(path).where(F.col(column) == F.lit(value))
    files = max(1, math.ceil(stored_bytes(rows) / TARGET_FILE_BYTES))
    rows.repartitionByRange(files, *sort_by).sortWithinPartitions(*sort_by).write.mode("overwrite").parquet(staging)
    (
        spark.read.parquet(staging)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def bloom_options(distinct: dict[str, int], fpp: float = 0.01) -> dict[str, str]:
    """Options of a Parquet write that put a Bloom filter for each column into every row group; `distinct`
    names the different values that a row group is expected to hold.

    An equality test then skips row groups whose least and greatest value enclose an absent key. The
    filters take about 1.2 bytes a value at one in a hundred. Dictionaries are off for these columns: a
    column wholly in a dictionary gets no filter.
    """
    out = {}
    for c, n in distinct.items():
        out |= {
            f"parquet.bloom.filter.enabled#{c}": "true",
            f"parquet.bloom.filter.expected.ndv#{c}": str(max(1, n)),
            f"parquet.bloom.filter.fpp#{c}": str(fpp),
            f"parquet.enable.dictionary#{c}": "false",
        }
    return out


def rows_scanned(df: DataFrame) -> tuple[int, int]:
    """(rows of `df`, rows that its single file scan read) after one run, from Spark's metrics. For a
    plan of one scan without an exchange."""
    found = len(df.collect())
    return found, df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()
