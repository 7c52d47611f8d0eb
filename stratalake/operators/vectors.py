"""Nearest vectors by cosine: exact in blocks, or with candidates from hyperplane hashing.

Vectors are packed into blocks, a matrix per row, so that Spark moves few rows and a task
multiplies matrices. A block of queries and a block of vectors give at most `k` rows per query.

`exact_top_k` compares the stated queries with all vectors, block by block. `lsh_top_k` compares
only blocks that share a bucket: every table has some random hyperplanes, a vector's signs are its
bucket, and a query also probes the buckets whose planes it is closest to. Buckets of any size are
cut into blocks, so no task holds a bucket and no candidate is left out. What is copied between
tables are vectors, never pairs.

Vectors that are null, empty or zero, hold a null or NaN, or have another length than most have no
direction: they are neither found nor do they find anything. Equal similarities (to nine places)
go by id. A query does not find itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.session import scratch_path

BLOCK = 1024
DIGITS = 9
SEED = 7


def directions(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec): vectors of length one, of the most frequent dimension."""
    values = F.transform(vec_col, lambda x: x.cast("double"))
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), values.alias("vec")).withColumn("size", F.sqrt(square))
    rows = rows.where("id IS NOT NULL AND size > 0 AND size < double('Infinity') AND NOT exists(vec, x -> x IS NULL OR isnan(x))")
    sizes = rows.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "n").first()
    if sizes is not None:
        rows = rows.where(F.size("vec") == sizes["n"])
    return rows.select("id", F.transform("vec", lambda x: x / F.col("size")).alias("vec"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _packed(rows: DataFrame, bucketed: bool) -> DataFrame:
    """(ids, block), one row per block; with (bucket) the rows of a bucket only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "ids", "block"]
        for batch in batches:
            buckets = batch.column(2).to_numpy() if bucketed else np.zeros(batch.num_rows, np.int64)
            ids, matrix = batch.column(0).to_numpy(), _matrix(batch.column(1))
            order = np.argsort(buckets, kind="stable")
            cuts = np.flatnonzero(np.diff(buckets[order])) + 1
            parts = [p[a : a + BLOCK] for p in np.split(order, cuts) for a in range(0, len(p), BLOCK)]
            parts = [p for p in parts if len(p)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(buckets[p[0]]) for p in parts], pa.int64()),
                    pa.array([ids[p].tobytes() for p in parts], pa.binary()),
                    pa.array([matrix[p].tobytes() for p in parts], pa.binary()),
                ],
                names,
            )

    return rows.mapInArrow(run, "bucket long, ids binary, block binary")


def _best_of_blocks(pairs: DataFrame, k: int) -> DataFrame:
    """(query_id, id, similarity): the best k of each pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                queries = np.frombuffer(row["q_block"]).reshape(len(q_ids), -1)
                vectors = np.frombuffer(row["block"]).reshape(len(ids), -1)
                found = np.round(np.clip(queries @ vectors.T, -1, 1), DIGITS) + 0.0
                found[q_ids[:, None] == ids] = -np.inf
                order = np.lexsort((np.broadcast_to(ids, found.shape), -found), axis=1)[:, :k]
                best = np.take_along_axis(found, order, 1)
                there = np.isfinite(best)
                columns = np.broadcast_to(q_ids[:, None], order.shape)[there], ids[order][there], best[there]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "id", "similarity"])

    return pairs.select("q_ids", "q_block", "ids", "block").mapInArrow(run, "query_id long, id long, similarity double")


def _top(found: DataFrame, k: int) -> DataFrame:
    """The best k per query; a task sends no more than k rows of a query."""
    w = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "id", "similarity")


def _as_queries(blocks: DataFrame) -> DataFrame:
    return blocks.select("bucket", F.col("ids").alias("q_ids"), F.col("block").alias("q_block"))


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "id", vec_col: str = "vec") -> DataFrame:
    """(query_id, rank, id, similarity) of all vectors, for a stated set of queries.

    `queries` has the same columns as `vectors`. Each block of queries meets each block of vectors
    once: (queries / BLOCK) x (vectors / BLOCK) rows of matrices, at most k rows per query out of each."""
    # Stored, since each block is read once per block of the other side.
    asked = _as_queries(_stored(_packed(directions(queries, id_col, vec_col), False))).drop("bucket")
    blocks = _stored(_packed(directions(vectors, id_col, vec_col), False))
    return _top(_best_of_blocks(blocks.crossJoin(asked), k), k)


class Planes:
    """Random hyperplanes: `tables` times `bits`."""

    def __init__(self, tables: int, bits: int, probes: int):
        self.tables, self.bits, self.probes = tables, bits, probes

    def _products(self, matrix: np.ndarray) -> np.ndarray:
        planes = np.random.default_rng(SEED).standard_normal((matrix.shape[1], self.tables * self.bits))
        return (matrix @ planes).reshape(len(matrix), self.tables, self.bits)

    def buckets(self, matrix: np.ndarray, probe: bool) -> np.ndarray:
        """Vectors x tables x probes: the own bucket, then those with the nearest planes crossed."""
        side = self._products(matrix)
        signs = (side > 0).astype(np.int64)
        weights = 1 << np.arange(self.bits, dtype=np.int64)
        own = (signs * weights).sum(axis=2) + (np.arange(self.tables, dtype=np.int64) << self.bits)
        if not probe:
            return own[:, :, None]
        # Sets of planes to cross, cheapest first by the sum of squared distances: none, one, two.
        nearest = np.argsort(np.abs(side), axis=2, kind="stable")[:, :, : self.probes]
        distance = np.take_along_axis(side**2, nearest, 2)
        n = nearest.shape[2]
        sets = [(i,) for i in range(n)] + [(i, j) for i in range(n) for j in range(i)]
        cost = np.stack([sum(distance[:, :, i] for i in s) for s in sets], axis=2)
        change = np.stack([np.sum([np.where(signs, -1, 1)[np.arange(len(own))[:, None], np.arange(self.tables), nearest[:, :, i]] * weights[nearest[:, :, i]] for i in s], axis=0) for s in sets], axis=2)
        cheapest = np.argsort(cost, axis=2, kind="stable")[:, :, : self.probes]
        return np.concatenate([own[:, :, None], own[:, :, None] + np.take_along_axis(change, cheapest, 2)], axis=2)

    def spread(self, rows: DataFrame, probe: bool) -> DataFrame:
        """(id, vec, bucket): a row per table, and per probe."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                found = self.buckets(_matrix(batch.column(1)), probe).reshape(batch.num_rows, -1)
                at = pa.array(np.repeat(np.arange(batch.num_rows), found.shape[1]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(found.ravel())], ["id", "vec", "bucket"])

        return rows.mapInArrow(run, "id long, vec array<double>, bucket long")


def lsh_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "id",
    vec_col: str = "vec",
    tables: int = 12,
    bits: int | None = None,
    probes: int = 12,
    bucket_rows: int = 64,
) -> DataFrame:
    """(query_id, rank, id, similarity) like `exact_top_k`, among the vectors that share a bucket.

    By default so many planes that a bucket has about `bucket_rows` vectors: each query then looks
    at `tables` x (`probes` + 1) buckets of that size, however many vectors there are. Measure the recall
    against `exact_top_k` on a set of queries (`recall`) and add tables or probes where it is too low."""
    rows = _stored(directions(vectors, id_col, vec_col))
    if bits is None:
        bits = max(1, int(np.ceil(np.log2(max(2, rows.count() / bucket_rows)))))
    planes = Planes(tables, bits, min(probes, bits * (bits + 1) // 2))
    blocks = _packed(_near(planes.spread(rows, False)), True)
    asked = _as_queries(_packed(_near(planes.spread(directions(queries, id_col, vec_col), True)), True))
    # A vector may be met in several tables.
    return _top(_best_of_blocks(blocks.join(asked, "bucket"), k).distinct(), k)


def _near(spread: DataFrame) -> DataFrame:
    """Rows of a bucket side by side, so that blocks are full; a large bucket may span tasks."""
    return spread.repartitionByRange("bucket", "id").sortWithinPartitions("bucket")


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "vectors")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: neighbours of `exact`, those also in `found`, and their share."""
    hits = exact.select("query_id", "id").join(found.select("query_id", "id").withColumn("hit", F.lit(1)), ["query_id", "id"], "left")
    return hits.agg(F.count(F.lit(1)).alias("neighbours"), F.count("hit").alias("found")).withColumn("recall", F.try_divide("found", "neighbours"))
