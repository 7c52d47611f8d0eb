"""Small helpers that the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.joins import fits_broadcast
from stratalake.session import scratch_path

#: White space is the space and the control characters 9 to 13; everything else is part of a word.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


#: Texts reach Python in batches of so many rows and about so many bytes: what a worker and the
#: executor hold at a time is then small, however long the texts are.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": "4194304"}


def in_small_batches(df: DataFrame) -> DataFrame:
    """`df`, with the session set to small Arrow batches."""
    for key, value in BATCH.items():
        df.sparkSession.conf.set(key, value)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back: computed once, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that `df` does not have yet (names compare without case)."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def keyed(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """`df` staged with a number per row, and that column's name.

    The number is drawn once and stored, so later reads agree on it, repeated rows and rows
    without an id included.
    """
    key = fresh(df, "row_key")
    return staged(df.withColumn(key, F.monotonically_increasing_id()), name), key


def join_checked(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with `right` broadcast when its measured size allows it, shuffled otherwise.

    Semi and anti joins keep the order of the columns of `left`."""
    out = left.join(F.broadcast(right) if fits_broadcast(right) else right, on, how)
    return out.select(*[f"`{c}`" for c in left.columns]) if how in ("left_anti", "left_semi") else out


def fold_is(doc_id: Column, folds: int, held: int) -> Column:
    """Whether crc32 of the id as text leaves `held` modulo `folds`; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == held, F.lit(True))


def bounded_sample(df: DataFrame, key: Column, most: int) -> DataFrame:
    """About `most` rows at most, drawn by a hash of `key` (the same rows in every run)."""
    total = df.count()
    if total <= most:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30)) < int((1 << 30) * (most / total)))


def one_per_id(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per id: that whose text has the smallest hash, then the smallest other columns.

    Every task keeps one row per id before the shuffle, so an id on a third of the rows is one row in
    whatever task comes next."""
    others = [c for c in df.columns if c != doc_id]
    least = F.min(F.struct(F.xxhash64(text).alias("order"), *others)).alias("least")
    return df.groupBy(doc_id).agg(least).select(doc_id, *[f"least.{c}" for c in others])


def bounded_per_group(df: DataFrame, group: Column, key: Column, most: int) -> DataFrame:
    """About `most` rows of each group at most, drawn by a hash of `key`; small groups stay whole. A count per group
    goes through the driver: groups are expected to be few."""
    counts = df.groupBy(group.alias("group")).count().where(F.col("count") > most).collect()
    if not counts:
        return df
    shares = F.create_map(*[F.lit(x) for r in counts for x in (r["group"], int((1 << 30) * (most / r["count"])))])
    drawn = F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30))
    return df.where(drawn < F.coalesce(F.element_at(shares, group), F.lit(1 << 30)))
