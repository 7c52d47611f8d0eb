"""Erasing the rows of some subjects from Parquet tables, by rewriting only the files that hold them.

The files with a subject's rows are found by a scan of the key column alone; their other rows are
written anew by `rewrite.replace_files`, which can be finished after an interruption. All other
files stay as they are. One writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.filesystem import Files
from stratalake.operators.joins import join_small
from stratalake.operators.rewrite import recover, replace_files


@dataclass(frozen=True)
class Report:
    rows_erased: int
    files_rewritten: int
    files_untouched: int


def files_holding(table: DataFrame, key: str, subjects: DataFrame) -> DataFrame:
    """(file, rows): the files of a table over Parquet that hold rows of the subjects."""
    keys = subjects.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
    rows = table.select(key, F.col("_metadata.file_path").alias("file"))
    return join_small(rows, keys, key, "left_semi").groupBy("file").agg(F.count(F.lit(1)).alias("rows"))


def erase(spark: SparkSession, root: str, key: str, subjects: DataFrame) -> Report:
    """Remove the rows whose `key` is among the subjects' keys (column of the same name).

    Rows without a key stay. Schema, partition folders and untouched files stay, too. The names of
    the files to be rewritten pass through the driver, as do those of every file Spark plans to read."""
    files, root = Files(spark), root.rstrip("/")
    recover(spark, root)
    table = spark.read.option("mergeSchema", "true").parquet(root)
    held = {files.plain(r.file): r.rows for r in files_holding(table, key, subjects).toLocalIterator()}
    total = sum(1 for _ in files.below(root))
    if not held:
        return Report(0, 0, total)
    data = {f.name for f in spark.read.parquet(next(iter(held))).schema}
    folders = [c for c in table.columns if c not in data]
    keys = subjects.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
    kept = spark.read.option("basePath", root).schema(table.schema).parquet(*held)
    # an anti join keeps rows without a key
    kept = join_small(kept, keys, key, "left_anti").select(*table.columns)
    replace_files(spark, root, list(held), kept, folders)
    return Report(sum(held.values()), len(held), total - len(held))


def erase_everywhere(spark: SparkSession, tables: dict[str, tuple[str, DataFrame]]) -> dict[str, Report]:
    """`erase` for several tables: root -> (key column, subjects)."""
    return {root: erase(spark, root, key, subjects) for root, (key, subjects) in tables.items()}
