"""Near-duplicates by SimHash fingerprints and covering bit masks.

A fingerprint is the bitwise majority over the XXH64 values of a text's word shingles. Two
texts are linked when their fingerprints differ in at most `RADIUS` bits; a class is what can
be reached over links.

Finding the links: each bit position gets a non-zero vector of RADIUS + 1 bits, in turn. For
every non-zero vector v the mask keeps the positions whose vector has an odd product with v.
The at most RADIUS differing positions span at most RADIUS dimensions, so some v is orthogonal
to all of them and its mask sees no difference: every pair within the radius meets in one of
the 2^(RADIUS + 1) - 1 tables. This is a guarantee, not a probability.

Equal fingerprints are merged first. A bucket with more than `CHUNK` fingerprints is cut into
chunks, and each pair of chunks is compared by a group of its own, so no task holds a large
bucket and no pair is left out. Groups send on one link per fingerprint (to the smallest one
it is connected with inside the group), not all pairs.

Null, empty and blank texts have fingerprint zero and are linked like any other. Null ids sort
last; repeated rows share a fingerprint; an empty table gives no rows; other columns are not
read. Long texts are hashed in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import in_small_batches, join_checked, staged
from stratalake.llm.components import components

BITS, RADIUS, CHUNK = 64, 3, 1024
SHINGLE_WORDS, HASH_SEED, BLOCK = 3, 42, 1 << 16


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def masks(radius: int = RADIUS) -> list[int]:
    """The covering family as unsigned 64-bit masks."""
    size = (1 << (radius + 1)) - 1
    vectors = [1 + i % size for i in range(BITS)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, size + 1)]


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Unsigned fingerprint of one whole text."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # both work on ASCII alone
    if not parts:
        return 0
    joined, width = b" ".join(parts), min(words, len(parts))
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(parts) - width + 1]
    ends = ends[width - 1 :] - 1
    ones, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        spans = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist())
        hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(key, doc_id, fp) with fp as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [signed(fingerprint(t.as_py(), words)) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())], ["key", "doc_id", "fp"])

    source = docs.select(F.col(key).alias("key"), F.col(doc_id).alias("doc_id"), F.col(text).alias("body"))
    kinds = dict(source.dtypes)
    return in_small_batches(source).mapInArrow(run, f"key {kinds['key']}, doc_id {kinds['doc_id']}, fp long")


def forest(values: np.ndarray, group: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (value, smallest value it is connected with) inside each run of equal `group`."""
    n = len(values)
    label, index, left, right = np.arange(n), np.arange(n - 1), [], []
    lag = 1
    while len(index := index[index + lag < n]) and len(index := index[group[index] == group[index + lag]]):
        near = np.bitwise_count(values[index] ^ values[index + lag]) <= radius
        left.append(index[near])
        right.append(index[near] + lag)
        lag += 1
    if not left:
        return values[:0], values[:0]
    a, b = np.concatenate(left), np.concatenate(right)
    while True:  # hook to the smaller label and shorten, until nothing moves
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    moved = label != np.arange(n)
    return values[moved], values[label[moved]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (gid, fp) with equal gids together; a run may go over several batches."""

    def links(gid, fp):
        group = np.cumsum(np.concatenate([[0], gid[1:] != gid[:-1]])) if len(gid) else gid
        a, b = forest(fp, group)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    rest_gid, rest_fp = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        gid = np.concatenate([rest_gid, batch.column(0).to_numpy()])
        fp = np.concatenate([rest_fp, batch.column(1).to_numpy()])
        if not len(gid):
            continue
        cut = int(np.flatnonzero(gid != gid[-1])[-1]) + 1 if gid[0] != gid[-1] else 0
        if cut:
            yield links(gid[:cut], fp[:cut])
        rest_gid, rest_fp = gid[cut:], fp[cut:]
    if len(rest_gid):
        yield links(rest_gid, rest_fp)


def links(fps: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints (distinct, column fp) within the radius."""
    tables = F.array(
        *[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("k")) for t, m in enumerate(masks(radius))]
    )
    spread = fps.select("fp", F.explode(tables).alias("x")).select("fp", "x.t", "x.k")
    several = spread.groupBy("t", "k").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    several = staged(several.withColumn("chunks", F.ceil(F.col("size") / chunk).cast("int")), "buckets")
    members = join_checked(spread, several, ["t", "k"])
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    pairs = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    # A group number may stand for two groups by accident: the fingerprints are compared anyway.
    gid = F.xxhash64("t", "k", F.least("own", "other"), F.greatest("own", "other"))
    groups = pairs.select(gid.alias("gid"), "fp").repartition("gid").sortWithinPartitions("gid", "fp")
    return groups.mapInArrow(_forests, "a long, b long").distinct()


def near_groups(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """(key, doc_id, fp, fingerprint, component_id, first_key), one row per row of `docs`.

    component_id is the smallest id of the class and first_key the row it belongs to.
    """
    marks = staged(fingerprints(docs, key, doc_id, text, words), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    distinct = staged(marks.groupBy("fp").agg(F.min(order).alias("least")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), radius))
    linked = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    leaders = linked.groupBy("root").agg(F.min("least").alias("least"))
    classes = linked.select("fp", "root").join(leaders, "root").select("fp", "least")
    out = marks.join(classes, "fp")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return out.select(
        "key", "doc_id", "fp", digits.alias("fingerprint"), F.col("least.doc_id").alias("component_id"), F.col("least.key").alias("first_key")
    )


def keep_leaders(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of `docs` that lead their class, all columns."""
    found = near_groups(docs, key, doc_id, text, words, radius)
    dropped = found.where("key != first_key").select(F.col("key").alias(key))
    return join_checked(docs, staged(dropped, "near-dropped"), key, "left_anti")
