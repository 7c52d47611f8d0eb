"""Reads from relational databases, split over tasks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession


def table(
    spark: SparkSession,
    url: str,
    name: str,
    properties: dict[str, str] | None = None,
    split_on: str | None = None,
    parts: int = 16,
) -> DataFrame:
    """A whole table. With `split_on` (a numeric, date or timestamp column) the bounds are
    fetched by one pushed-down query and the table is read by `parts` tasks."""
    properties = properties or {}
    if split_on is None:
        return spark.read.jdbc(url, name, properties=properties)
    edges = f"(SELECT MIN({split_on}) AS lo, MAX({split_on}) AS hi FROM {name}) edges"
    lo, hi = spark.read.jdbc(url, edges, properties=properties).first()
    if lo is None:
        return spark.read.jdbc(url, name, properties=properties)
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=name, **properties)
        .option("partitionColumn", split_on)
        .option("lowerBound", str(lo))
        .option("upperBound", str(hi))
        .option("numPartitions", parts)
        .load()
    )


def query(spark: SparkSession, url: str, sql: str, alias: str = "q", properties: dict[str, str] | None = None) -> DataFrame:
    """The result of a query that the database runs."""
    return spark.read.jdbc(url, f"({sql}) {alias}", properties=properties or {})


def changed_since(
    spark: SparkSession, url: str, name: str, column: str, after: datetime, properties: dict[str, str] | None = None
) -> DataFrame:
    """Rows changed after a point in time, filtered in the database."""
    stamp = after.strftime("%Y-%m-%d %H:%M:%S.%f")
    return query(spark, url, f"SELECT * FROM {name} WHERE {column} > '{stamp}'", "changed", properties)
