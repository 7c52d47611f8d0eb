"""Exact duplicates: grouped by a 128-bit hash, told apart by their bytes.

Texts are equal when nothing but white space differs. Of equal texts the longest original
(code points) stays, then the smallest id, then the first row.

Two passes. The first keeps a few numbers per row and counts the rows of each hash; copies
are combined before the shuffle. The second fetches texts only for hashes that several rows
share and compares their bytes: the smallest and the largest text of a hash, combined before
the shuffle, are the same exactly when all are. A hash with different texts is a collision, and
its rows are then grouped by the text itself.

Nulls and empty texts form one group; null ids sort last; repeated rows are told apart by the
row key; an empty table gives no rows. Other columns are neither read nor changed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import SPACE, join_checked, staged


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", "")


def exact_groups(
    docs: DataFrame,
    key: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    content_hash: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """(key, doc_id, keep_key, keep_id, group_size, kept, text_sha256), one row per row of `docs`.

    `key` is unique per row and the same on every read; without it rows are numbered here, for
    callers that don't need to find them again.
    """
    key = F.monotonically_increasing_id() if key is None else key
    texts = docs.select(key.alias("key"), F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    texts = texts.withColumn("norm", normalised(F.col("body"))).withColumn("hash", content_hash(F.col("norm")))
    facts = ["key", "doc_id", "hash", F.sha2("norm", 256).alias("text_sha256"), F.char_length("body").cast("long").alias("points")]
    marks = staged(texts.select(*facts), "exact-marks")
    shared = staged(marks.groupBy("hash").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("hash"), "exact-shared")
    same = join_checked(texts.select("hash", "norm"), shared, "hash").groupBy("hash")
    collided = staged(same.agg(F.min("norm").alias("lo"), F.max("norm").alias("hi")).where("lo != hi").select("hash"), "exact-collided")
    by = ["hash"]
    if not collided.isEmpty():
        apart = staged(texts.join(collided, "hash").select(*facts, F.col("norm").alias("variant")), "exact-apart")
        marks = marks.join(collided, "hash", "left_anti").withColumn("variant", F.lit("")).unionByName(apart)
        by = ["hash", "variant"]
    order = F.struct(-F.col("points"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))
    groups = marks.groupBy(*by).agg(F.count(F.lit(1)).alias("group_size"), F.min(order).alias("best")).where("group_size > 1")
    groups = groups.select(*by, "group_size", F.col("best.key").alias("keep_key"), F.col("best.doc_id").alias("keep_id"))
    # Rows that are alone find no group.
    out = join_checked(marks, staged(groups, "exact-groups"), by, "left")
    alone = F.col("group_size").isNull()
    return out.select(
        "key",
        "doc_id",
        F.coalesce("keep_key", "key").alias("keep_key"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep_key") == F.col("key"))).alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, all columns."""
    dropped = exact_groups(docs, F.col(key), doc_id, text).where("not kept").select(F.col("key").alias(key))
    return join_checked(docs, staged(dropped, "exact-dropped"), key, "left_anti")
