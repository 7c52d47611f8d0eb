"""Table and file writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.keyed import KeyedParquet


def add_bronze_audit_cols(df: DataFrame, loaded: Column | None = None) -> DataFrame:
    """Source file and load time of rows read from files."""
    return df.withColumn("source_file", F.col("_metadata.file_path")).withColumn(
        "bronze_loaded_ts_utc", F.current_timestamp() if loaded is None else loaded
    )


def add_silver_audit_cols(df: DataFrame, loaded: Column | None = None) -> DataFrame:
    return df.withColumn("silver_loaded_ts_utc", F.current_timestamp() if loaded is None else loaded)


def add_ingestion_time(df: DataFrame) -> DataFrame:
    return df.withColumn("ingestion_timestamp", F.current_timestamp())


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace a table; its schema becomes that of the DataFrame."""
    df.write.mode("overwrite").saveAsTable(table)


def write_partitioned(df: DataFrame, path: str, *by: str, mode: str = "overwrite") -> None:
    """Partitioned files. The rebalance hint gathers the rows of a partition into few
    files and lets adaptive execution split a partition that is far larger than others."""
    df.hint("rebalance", *[F.col(c) for c in by]).write.mode(mode).partitionBy(*by).parquet(path)


def replace_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replace exactly the partitions present in `df`: a repeated load is idempotent."""
    writer = df.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_table(
    df: DataFrame,
    target_table: str,
    partition_by: list[str] | None = None,
    mode: str = "append",
    keys: list[str] | None = None,
    merge_path: str | None = None,
) -> None:
    """Write to a three-part table name (catalog.schema.table).

    `append` adds rows, with new columns added to the table first; `overwrite` replaces;
    `replace` swaps only the partitions present in the data; `merge` upserts by `keys`
    into a keyed table at `merge_path`.
    """
    parts = target_table.split(".")
    if len(parts) != 3 or not all(parts):
        raise ValueError(f"target_table must be catalog.schema.table, got {target_table!r}")
    if mode not in ("append", "overwrite", "replace", "merge"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "merge" and not (keys and merge_path):
        raise ValueError("merge needs keys and merge_path")
    spark = df.sparkSession
    try:
        if mode == "merge":
            KeyedParquet(spark, merge_path, keys).merge(df)
            return
        exists = spark.catalog.tableExists(target_table)
        if mode == "overwrite" or not exists:
            writer = df.write.mode("overwrite")
            (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(target_table)
            return
        if mode == "append":
            _add_missing_columns(spark, target_table, df.schema)
        present = spark.table(target_table).schema
        aligned = df.select(
            *[
                F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                for f in present.fields
            ]
        )
        if mode == "append":
            aligned.write.insertInto(target_table)
        else:
            with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
                aligned.write.insertInto(target_table, overwrite=True)
    except Exception as e:
        raise RuntimeError(f"write to {target_table} failed: {e}") from e


def _add_missing_columns(spark: SparkSession, table: str, schema: T.StructType) -> None:
    have = set(spark.table(table).columns)
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in have]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")


class _setting:
    def __init__(self, spark: SparkSession, key: str, value: str):
        self.conf, self.key, self.value = spark.conf, key, value

    def __enter__(self):
        self.before = self.conf.get(self.key)
        self.conf.set(self.key, self.value)

    def __exit__(self, *_):
        self.conf.set(self.key, self.before)


def register_external(spark: SparkSession, table: str, path: str) -> None:
    """A table over files that already exist; dropping it leaves the files."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{path}'")
    if spark.catalog.listColumns(table) and any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.sql(f"MSCK REPAIR TABLE {table}")


def create_table(spark: SparkSession, table: str, columns: dict[str, tuple[str, str]], comment: str = "") -> None:
    """`CREATE TABLE IF NOT EXISTS` with a type and a comment per column."""
    body = ", ".join(f"{name} {kind} COMMENT '{note}'" for name, (kind, note) in columns.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({body}) USING parquet COMMENT '{comment}'")


def create_or_replace_as(spark: SparkSession, table: str, df: DataFrame) -> None:
    """`CREATE OR REPLACE TABLE ... AS` for a session catalog: the rows are written to a
    staging table first and renamed, so a failing query leaves the old table in place."""
    staging = f"{table}__new"
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    df.write.saveAsTable(staging)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")


def discard(df: DataFrame) -> None:
    """Run the whole plan and throw the rows away."""
    df.write.format("noop").mode("overwrite").save()
