"""Merging into plain Parquet that is partitioned by a hash bucket of the key.

The number of buckets follows the size of the content and is part of every path
(`key_buckets=8/key_bucket=3`), so every handle finds it in the data. A merge stages its
source once, reads the buckets that the staged rows touch, stages the merged rows and replaces
just those partitions from the staged copy. A merge that is repeated gives the same table.

When the mean bucket has grown past `GROWN` times its wanted size, the next merge deals the whole
table anew: a table that grows for ever is rewritten once for each time it gets that much larger, and
every other merge touches its own buckets only.

Replacing folders is no single step, so a note beside the table names the complete staged copy first.
A writer that finds a note repeats that replacement, which gives the same folders, before it does
anything else; `recover` does only that. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.filesystem import Files
from stratalake.operators.dedup import content_order, latest_per_key
from stratalake.operators.merge import merge_upsert, require_unique
from stratalake.session import scratch_path

BUCKETS, BUCKET = "key_buckets", "key_bucket"
BUCKET_BYTES = 256 * 1024 * 1024
GROWN = 4


def stored_bytes(df: DataFrame) -> int:
    """Size of the files that a frame over files reads, from their listing."""
    files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.sum("file_size")).first()[0] or 0


class KeyedParquet:
    def __init__(self, spark: SparkSession, root: str, keys: list[str], bucket_bytes: int = BUCKET_BYTES):
        self.spark, self.root, self.keys, self.bucket_bytes = spark, root.rstrip("/"), list(keys), bucket_bytes

    def _stored(self) -> DataFrame | None:
        try:
            return self.spark.read.option("mergeSchema", "true").parquet(self.root)
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def _buckets(self, stored: DataFrame | None) -> int:
        """The bucket count in the paths; 0 without content."""
        row = None if stored is None or BUCKETS not in stored.columns else stored.select(BUCKETS).first()
        return 0 if row is None else row[0]

    def exists(self) -> bool:
        return self._stored() is not None

    def read(self) -> DataFrame:
        stored = self._stored()
        if stored is None:
            raise ValueError(f"no table at {self.root}")
        return stored.drop(BUCKETS, BUCKET)

    def _placed(self, df: DataFrame, buckets: int) -> DataFrame:
        # hashed as text so that an INT key and a BIGINT key meet in the same bucket
        bucket = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(buckets)).cast("int")
        return df.withColumn(BUCKETS, F.lit(buckets)).withColumn(BUCKET, bucket)

    def _stage(self, df: DataFrame) -> DataFrame:
        return self._staged(df)[0]

    def _staged(self, df: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_path(self.spark, "merge")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def _write(self, df: DataFrame, mode: str) -> None:
        rows = df.hint("rebalance", F.col(BUCKET))
        rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(BUCKETS, BUCKET).parquet(self.root)

    @property
    def _note(self) -> str:
        return f"{self.root}.swap"

    def _swap(self, path: str, mode: str, buckets: int) -> None:
        """Replace from the staged copy at `path`, which is dealt to `buckets` (0: it is already)."""
        note = [(path, mode, buckets)]
        self.spark.createDataFrame(note, "path STRING, mode STRING, buckets INT").coalesce(1).write.mode("overwrite").json(self._note)
        self.recover()

    def recover(self) -> None:
        """Finish a replacement that was begun, if there is one."""
        files = Files(self.spark)
        if files.exists(self._note):
            if files.exists(f"{self._note}/_SUCCESS"):
                note = self.spark.read.schema("path STRING, mode STRING, buckets INT").json(self._note).first()
                rows = self.spark.read.parquet(note.path)
                self._write(self._placed(rows, note.buckets) if note.buckets else rows, note.mode)
            files.delete(self._note)

    def overwrite(self, df: DataFrame) -> None:
        """Replace the content and the schema; the bucket count follows the new size."""
        self.recover()
        staged, path = self._staged(df)
        self._swap(path, "static", max(1, -(-stored_bytes(staged) // self.bucket_bytes)))

    def merge(self, source: DataFrame) -> None:
        """Upsert by key. A source with two rows for one key is refused."""
        self.recover()
        staged = self._stage(source)
        require_unique(staged, self.keys)
        self._replace(staged, lambda old: merge_upsert(old, staged, self.keys, check=False))

    def apply_changes(self, changes: DataFrame, sequence_by: str) -> None:
        """Keep the highest `sequence_by` per key among stored and incoming rows, so that a
        batch may come late, twice or from several feeds."""
        self.recover()
        staged = self._stage(changes)

        def newest(old: DataFrame) -> DataFrame:
            rows = old.unionByName(staged, allowMissingColumns=True)
            lead = F.col(sequence_by).desc_nulls_last()
            return latest_per_key(rows, self.keys, content_order(rows, [lead], (*self.keys, sequence_by)))

        self._replace(staged, newest)

    def _replace(self, staged: DataFrame, combine: Callable[[DataFrame], DataFrame]) -> None:
        stored = self._stored()
        buckets = self._buckets(stored)
        if not buckets:
            self.overwrite(combine(self.spark.createDataFrame([], staged.schema)))
            return
        if Files(self.spark).size(self.root) > GROWN * buckets * self.bucket_bytes:
            self.overwrite(combine(stored.drop(BUCKETS, BUCKET)))
            return
        touched = self._placed(staged, buckets).select(BUCKET).distinct()
        old = stored.join(F.broadcast(touched), BUCKET, "left_semi").drop(BUCKETS, BUCKET)  # a row per bucket
        merged, path = self._staged(self._placed(combine(old), buckets))
        foreign = merged.select(BUCKET).distinct().join(touched, BUCKET, "left_anti")
        if not foreign.isEmpty():
            raise RuntimeError("a merge produced rows of a bucket that it did not load")
        self._swap(path, "dynamic", 0)
