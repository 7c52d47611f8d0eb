"""Keeping a DataFrame for repeated use, with release guaranteed."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

LEVELS = {
    "MEMORY_ONLY": StorageLevel.MEMORY_ONLY,
    "MEMORY_AND_DISK": StorageLevel.MEMORY_AND_DISK,
    "DISK_ONLY": StorageLevel.DISK_ONLY,
}


@contextmanager
def kept(df: DataFrame, level: str = "MEMORY_AND_DISK") -> Iterator[DataFrame]:
    """The DataFrame persisted at the level inside the block, released after it.

    A lost executor loses its share of the cache only; Spark recomputes it.
    """
    df.persist(LEVELS[level])
    try:
        yield df
    finally:
        df.unpersist()
