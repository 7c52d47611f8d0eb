"""A clustered Parquet table that takes loads without being clustered anew.

The bounds that rank the clustering columns are sampled once and stored beside the files, so a row's
place on the curve never changes. Beside them is a list of the files with the first and last place of
each. A load rewrites only the files whose stretch of the curve holds one of its rows; all others
keep their names. Entries of files that are gone are passed over, files without one are
scanned, so an interrupted load leaves nothing to mend but what `rewrite.recover` finishes.
One writer at a time.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.filesystem import Files
from stratalake.operators.intervals import overlap_join
from stratalake.operators.joins import join_small
from stratalake.operators.layout import cluster_bounds, curve_place
from stratalake.operators.rewrite import recover, replace_files
from stratalake.session import scratch_path

PLACE, NOTES = "__z", "_cluster"
LISTED = "name STRING, first BIGINT, last BIGINT, n BIGINT"


@dataclass(frozen=True)
class Load:
    rows: int
    files_rewritten: int
    files_untouched: int


class ClusteredParquet:
    """The table at `root`, clustered by `cols`, in files of about `file_rows` rows."""

    def __init__(self, spark: SparkSession, root: str, cols: list[str], file_rows: int):
        self.spark, self.root, self.cols, self.file_rows = spark, root.rstrip("/"), cols, file_rows
        self._frozen: dict[str, list[tuple]] = {}

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.root)

    def create(self, rows: DataFrame) -> int:
        """Write the first rows; returns the number of files. Columns of later loads must be the same."""
        files = self._files_for(rows.count())
        for i, (c, values) in enumerate(cluster_bounds(rows, self.cols, files).items()):
            kept = self.spark.createDataFrame(values, rows.select(c).schema)
            kept.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{NOTES}/bounds-{i}")
        self._laid(curve_place(rows, self._bounds(), PLACE), files).write.mode("append").parquet(self.root)
        self._note()
        return sum(1 for _ in Files(self.spark).below(self.root))

    def load(self, rows: DataFrame) -> Load:
        """Add rows; only the files are rewritten that lie where new rows go."""
        spark, files = self.spark, Files(self.spark)
        recover(spark, self.root)
        path = scratch_path(spark, "load")
        curve_place(rows, self._bounds(), PLACE).write.parquet(path)
        new = spark.read.parquet(path)
        places = new.groupBy(F.col(PLACE).alias("at")).agg(F.count(F.lit(1)).alias("k"))  # a row per cell of the curve
        spans = (F.col("at"), F.col("at")), (F.col("first"), F.col("last"))
        hit = overlap_join(places, self._note(), [], *spans).groupBy("name").agg(F.max("n").alias("n"))
        old = {r["name"]: r["n"] for r in hit.toLocalIterator()}
        total, n = sum(1 for _ in files.below(self.root)), new.count()
        if n == 0:
            return Load(0, 0, total)
        both = new
        if old:
            held = spark.read.schema(rows.schema).parquet(*[f"{self.root}/{name}" for name in old])
            both = new.unionByName(curve_place(held, self._bounds(), PLACE))
        laid = self._laid(both, self._files_for(n + sum(old.values())))
        replace_files(spark, self.root, [f"{self.root}/{name}" for name in old], laid)
        self._note()
        return Load(n, len(old), total - len(old))

    def files(self) -> DataFrame:
        """(name, first, last, n) of every file: its stretch of the curve and its rows."""
        return self._note()

    def _files_for(self, rows: int) -> int:
        return max(1, math.ceil(rows / self.file_rows))

    def _bounds(self) -> dict[str, list[tuple]]:
        """At most layout.MOST_RANKS values a column; read once, for they never change."""
        for i, c in enumerate(self.cols):
            if c not in self._frozen:
                stored = self.spark.read.parquet(f"{self.root}/{NOTES}/bounds-{i}").orderBy(c).collect()
                self._frozen[c] = [tuple(r) for r in stored]
        return self._frozen

    def _laid(self, placed: DataFrame, files: int) -> DataFrame:
        by = [PLACE, *self.cols]
        return placed.repartitionByRange(files, *by).sortWithinPartitions(*by).drop(PLACE)

    def _note(self) -> DataFrame:
        """The list of the files that are there, after the unlisted ones are scanned and listed."""
        spark, notes = self.spark, f"{self.root}/{NOTES}/files"
        names = spark.createDataFrame([(n,) for n in Files(spark).below(self.root)], "name STRING")
        listed = spark.createDataFrame([], LISTED)
        if Files(spark).exists(notes):
            listed = spark.read.schema(LISTED).parquet(notes).dropDuplicates(["name"])
        unlisted = [r["name"] for r in join_small(names, listed, "name", "left_anti").toLocalIterator()]
        if unlisted:
            rows = spark.read.parquet(*[f"{self.root}/{n}" for n in unlisted]).select(*self.cols, F.col("_metadata.file_name").alias("name"))
            found = curve_place(rows, self._bounds(), PLACE).groupBy("name").agg(
                F.min(PLACE).alias("first"), F.max(PLACE).alias("last"), F.count(F.lit(1)).alias("n")
            )
            found.write.mode("append").parquet(notes)
            listed = spark.read.schema(LISTED).parquet(notes).dropDuplicates(["name"])
        return listed.join(names, "name", "left_semi")
