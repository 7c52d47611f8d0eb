"""Full, incremental and daily loads."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators import quality
from stratalake.operators.sinks import add_ingestion_time, overwrite_table
from stratalake.operators.keyed import KeyedParquet
from stratalake.session import scratch_path
from stratalake.sources.files import dated_partition

# The watermark of a source that was never loaded.
BEGINNING = datetime(1900, 1, 1)


def enrich_sales(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Amount, year and month per sale, with the product columns."""
    amounts = (
        sales.withColumn("total_amount", F.col("quantity") * F.col("unit_price"))
        .withColumn("sale_year", F.year("sale_date"))
        .withColumn("sale_month", F.month("sale_date"))
    )
    return amounts.join(products, "product_id", "left")


# -- full load -------------------------------------------------------------


def full_load(source: DataFrame, table: str) -> int:
    """Replace the table with a stamped copy; returns the stored row count."""
    overwrite_table(add_ingestion_time(source), table)
    return source.sparkSession.table(table).count()


def verify_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    o, c = orders.alias("o"), customers.alias("c")
    return (
        o.join(c, F.col("o.customer_id") == F.col("c.customer_id"))
        .select("o.order_id", "o.order_date", "c.customer_name", "o.total_amount", "o.order_status")
        .orderBy(F.desc("order_date"), "order_id")
    )


# -- incremental load ------------------------------------------------------


class Watermarks:
    """Last loaded change time per source: one small keyed table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = KeyedParquet(spark, path, ["source_table"])

    def get(self, source: str) -> datetime:
        if not self.table.exists():
            return BEGINNING
        row = self.table.read().where(F.col("source_table") == source).first()
        return BEGINNING if row is None else row["last_watermark_value"]

    def set(self, source: str, value: datetime) -> None:
        row = self.spark.createDataFrame([(source, value)], "source_table STRING, last_watermark_value TIMESTAMP")
        self.table.merge(row.withColumn("updated_at", F.current_timestamp()))


def incremental_load(
    source_name: str,
    changed_after: Callable[[datetime], DataFrame],
    target: KeyedParquet,
    watermarks: Watermarks,
    changed_column: str,
    staging: str,
    overlap: timedelta = timedelta(0),
) -> dict:
    """Load the rows changed since the last run and advance the watermark.

    The changed rows are written to `staging` once; the count, the merge and the new
    watermark all come from that copy, so rows arriving meanwhile wait for the next run.
    The watermark moves last: a run that dies before is repeated, and the merge makes the
    repetition harmless. `overlap` re-reads a span before the watermark to catch late
    commits.
    """
    spark = target.spark
    since = watermarks.get(source_name)
    after = since if since == BEGINNING else since - overlap
    add_ingestion_time(changed_after(after)).write.mode("overwrite").parquet(staging)
    delta = spark.read.parquet(staging)
    found = delta.agg(F.count(F.lit(1)).alias("n"), F.max(changed_column).alias("top")).first()
    if found["n"] == 0:
        return {"rows": 0, "watermark": since}
    target.merge(delta)
    top = max(found["top"], since) if since != BEGINNING else found["top"]
    watermarks.set(source_name, top)
    return {"rows": found["n"], "watermark": top}


# -- daily sales load ------------------------------------------------------


def run_daily_sales(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    execution_date: str,
    min_pass_rate: float = 0.0,
    rates: dict[str, float] | None = None,
) -> dict:
    """Read one day, clean, validate, and write by processing date, then event date.

    Nothing is written when validation fails. The folder of the processing date is replaced
    as a whole, so repeating a day does not duplicate it, and late events of other days are
    added to those that earlier runs wrote. Two passes over the day's files: one for all
    metrics and checks, one for the write.
    """
    raw = dated_partition(spark, source_path, execution_date)
    metrics, checks = quality.metrics_and_checks(raw, execution_date, rates)
    if not quality.passes(checks, min_pass_rate, metrics["pass_rate_pct"]):
        raise RuntimeError("output validation failed, nothing written")
    cleaned = quality.clean_sales(raw, execution_date, rates)
    cleaned.drop("processing_date").write.mode("overwrite").partitionBy("event_date").parquet(
        f"{target_path.rstrip('/')}/processing_date={execution_date}"
    )
    return {
        "success": True,
        "records_written": metrics["output_records"],
        "quality_metrics": metrics,
        "error": None,
        "execution_date": execution_date,
    }


def publish_or_quarantine(
    df: DataFrame, rules: dict[str, str], publish_path: str, quarantine_path: str, run_date: str
) -> dict:
    """Rows that meet every rule are published; the others are kept apart with the names
    of the rules they broke. Both go into the folder of the run date, which a repeated run
    replaces; the rows are staged first, so both outputs come from the same rows."""
    path = scratch_path(df.sparkSession, "publish")
    df.write.parquet(path)
    passed, held = quality.split(df.sparkSession.read.schema(df.schema).parquet(path), rules)
    passed.write.mode("overwrite").parquet(f"{publish_path.rstrip('/')}/run_date={run_date}")
    held.write.mode("overwrite").parquet(f"{quarantine_path.rstrip('/')}/run_date={run_date}")
    return {"publish": publish_path, "quarantine": quarantine_path}


def post_checks(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, bool]:
    """Checks on the outputs of a run: rows present, dates set, amounts positive, and every
    ordering customer present in the feature table."""
    orders, features = tables["orders"], tables["fs_order_features"]
    missing = orders.select("customer_id").distinct().join(features.select("customer_id"), "customer_id", "left_anti")
    faults = {"sales_daily_metrics": F.col("date").isNull(), "orders": F.col("total_amount") <= 0}

    def counted(name: str):  # one aggregate per table
        fault = F.count_if(faults[name]) if name in faults else F.lit(0)
        return tables[name].agg(F.count(F.lit(1)).alias("n"), fault.alias("bad")).first()

    found = {name: counted(name) for name in tables}
    checks = {f"{name} has rows": row["n"] > 0 for name, row in found.items()}
    checks["daily metrics have dates"] = found["sales_daily_metrics"]["bad"] == 0
    checks["order amounts are positive"] = found["orders"]["bad"] == 0
    checks["features cover all customers"] = missing.isEmpty()
    return checks
