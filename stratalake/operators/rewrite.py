"""Replacing some files of a Parquet table, in steps that can be repeated.

The new rows are written to a folder below the table that readers skip, then the list of the files to
be replaced; only then are those files deleted and the new ones moved in. An interrupted replacement
is finished, or forgotten if its list was not complete, by `recover`. No reader ever finds a
kept row twice; one that reads between the last two steps can miss rows. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stratalake.filesystem import Files

WORK = "_erasure"


def replace_files(spark: SparkSession, root: str, old: list[str], rows: DataFrame, folders: list[str] | None = None) -> None:
    """Put `rows`, by partition `folders`, in the place of the files `old`."""
    work = f"{root}/{WORK}/{uuid.uuid4().hex[:12]}"
    (rows.write.partitionBy(*folders) if folders else rows.write).parquet(f"{work}/new")
    spark.createDataFrame([(f,) for f in sorted(old)], "file STRING").write.parquet(f"{work}/old")
    _finish(spark, root, work)


def recover(spark: SparkSession, root: str) -> None:
    """Finish what an interrupted replacement had prepared; remove what it had only begun."""
    files, root = Files(spark), root.rstrip("/")
    for name in files.children(f"{root}/{WORK}"):
        work = f"{root}/{WORK}/{name}"
        if files.exists(f"{work}/old/_SUCCESS"):
            _finish(spark, root, work)
        else:
            files.delete(work)


def _finish(spark: SparkSession, root: str, work: str) -> None:
    files = Files(spark)
    for row in spark.read.schema("file STRING").parquet(f"{work}/old").toLocalIterator():
        files.delete(row.file)
    for name in list(files.below(f"{work}/new")):
        files.move(f"{work}/new/{name}", f"{root}/{name}")
    files.delete(work)
