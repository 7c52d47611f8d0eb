"""Bronze -> silver -> star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.scalars import is_weekend, order_value_band, tenure_band
from stratalake.operators.dedup import drop_duplicate_keys, latest_per_key, newest_batch
from stratalake.operators.quality import (
    CUSTOMER_RULES,
    CUSTOMER_WARNINGS,
    ORDER_RULES,
    ORDER_WARNINGS,
    expect,
    expect_all_or_drop,
)
from stratalake.operators.ranges import add_dense_rank, add_row_number

LOADED = "bronze_loaded_ts_utc"

# The calendar covered by the date dimension.
CALENDAR = ("2024-01-01", "2025-12-31")


def _newest(df: DataFrame, key: str) -> DataFrame:
    # load time is constant within a load, so the remaining columns settle ties
    order = [F.col(LOADED).desc_nulls_last(), *[F.col(c) for c in df.columns if c not in (key, LOADED)]]
    return latest_per_key(df, [key], order)


def _stamp(df: DataFrame, loaded: Column | None) -> DataFrame:
    return df.drop(LOADED).withColumn("silver_loaded_ts_utc", F.current_timestamp() if loaded is None else loaded)


def silver_customers(bronze: DataFrame, loaded: Column | None = None) -> DataFrame:
    clean = bronze.select(
        F.trim("customer_id").alias("customer_id"),
        F.lower(F.trim("email")).alias("email"),
        F.trim("name").alias("name"),
        "city",
        "state",
        "country",
        F.to_date("signup_date").alias("signup_date"),
        "source_file",
        LOADED,
    )
    return _stamp(_newest(clean, "customer_id"), loaded)


def silver_orders(bronze: DataFrame, loaded: Column | None = None) -> DataFrame:
    clean = bronze.select(
        F.trim("order_id").alias("order_id"),
        F.trim("customer_id").alias("customer_id"),
        F.to_date("order_date").alias("order_date"),
        F.col("order_total").cast("double").alias("order_total"),
        "order_status",
        "source_file",
        LOADED,
    )
    return _stamp(_newest(clean, "order_id"), loaded)


def silver_products(bronze: DataFrame, loaded: Column | None = None) -> DataFrame:
    clean = bronze.select(
        F.trim("product_id").alias("product_id"),
        F.trim("product_name").alias("product_name"),
        F.trim("category").alias("category"),
        "subcategory",
        F.col("price").cast("double").alias("price"),
        "source_file",
        LOADED,
    )
    return _stamp(_newest(clean, "product_id"), loaded)


def silver_order_items(bronze: DataFrame, loaded: Column | None = None) -> DataFrame:
    """All items of the newest load of each order."""
    clean = bronze.select(
        F.trim("order_item_id").alias("order_item_id"),
        F.trim("order_id").alias("order_id"),
        F.trim("product_id").alias("product_id"),
        F.col("quantity").cast("int").alias("quantity"),
        F.col("unit_price").cast("double").alias("unit_price"),
        "source_file",
        LOADED,
    )
    return _stamp(newest_batch(clean, ["order_id"], LOADED), loaded)


def dim_customer(customers: DataFrame) -> DataFrame:
    described = customers.select("customer_id", "name", "email", "city", "state", "country", "signup_date")
    return add_row_number(described, ["customer_id"], "customer_sk").select("customer_sk", *described.columns)


def dim_product(products: DataFrame) -> DataFrame:
    described = products.select("product_id", "product_name", "category", "price")
    return add_row_number(described, ["product_id"], "product_sk").select("product_sk", *described.columns)


def calendar_columns(day: str = "date_value") -> list[Column]:
    return [
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.day(day).alias("day"),
        F.quarter(day).alias("quarter"),
        F.weekofyear(day).alias("week_of_year"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        F.dayofweek(day).alias("day_of_week_num"),
        is_weekend(day).alias("is_weekend"),
    ]


def dim_date(spark: SparkSession, first: str = CALENDAR[0], last: str = CALENDAR[1]) -> DataFrame:
    """One row per day; the key is the day's position, so no window is needed."""
    days = spark.sql(
        f"SELECT posexplode(sequence(DATE '{first}', DATE '{last}', INTERVAL 1 DAY)) AS (pos, date_value)"
    )
    return days.select((F.col("pos") + 1).alias("date_sk"), "date_value", *calendar_columns())


def fact_sales(
    items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame, dates: DataFrame
) -> DataFrame:
    """Order items with the keys of their dimensions. Dimensions join without hints: their
    size decides between broadcast and shuffle, and hot keys are split at run time."""
    sold = items.select("order_id", "order_item_id", "product_id", "quantity", "unit_price").join(
        orders.select("order_id", "customer_id", "order_date"), "order_id"
    )
    # numbered before the left joins, which keep every row: only the keys are ranked
    return (
        add_dense_rank(sold, ["order_id", "order_item_id"], "sale_id", bounds_from=items)
        .join(customers.select("customer_id", "customer_sk"), "customer_id", "left")
        .join(products.select("product_id", "product_sk"), "product_id", "left")
        .join(dates.select(F.col("date_value").alias("order_date"), "date_sk"), "order_date", "left")
        .select(
            "sale_id",
            "order_id",
            "order_item_id",
            "date_sk",
            "product_sk",
            "customer_sk",
            "quantity",
            "unit_price",
            (F.col("quantity") * F.col("unit_price")).alias("line_total"),
        )
    )


# -- checked silver tables -------------------------------------------------


def clean_orders(orders: DataFrame) -> DataFrame:
    """Date parts, value band and standard status; works on batches and streams."""
    return (
        orders.withColumn("order_date", F.to_timestamp(F.col("order_date")))
        .withColumn("order_year", F.year("order_date"))
        .withColumn("order_month", F.month("order_date"))
        .withColumn("order_quarter", F.quarter("order_date"))
        .withColumn("order_day_of_week", F.dayofweek("order_date"))
        .withColumn("order_value_category", order_value_band("order_total"))
        .withColumn("order_status", F.initcap(F.trim("order_status")))
    )


def checked_orders(orders: DataFrame, observe: str | None = None) -> DataFrame:
    """Clean orders, one row per order, with the rules applied after cleaning."""
    unique = orders if orders.isStreaming else drop_duplicate_keys(orders, ["order_id"])
    return expect_all_or_drop(expect(clean_orders(unique), ORDER_WARNINGS, observe), ORDER_RULES)


def clean_customers(customers: DataFrame, as_of: Column) -> DataFrame:
    days = F.datediff(as_of, F.col("signup_date"))
    return (
        customers.withColumn("signup_date", F.to_date("signup_date"))
        .withColumn("customer_tenure_days", days)
        .withColumn("customer_tenure_years", F.round(F.col("customer_tenure_days") / 365, 1))
        .withColumn("name", F.trim("name"))
        .withColumn("city", F.initcap(F.trim("city")))
        .withColumn("state", F.upper(F.trim("state")))
        .withColumn("country", F.initcap(F.trim("country")))
        .withColumn("email", F.lower(F.trim("email")))
        .withColumn("customer_tenure_segment", tenure_band("customer_tenure_days"))
    )


def checked_customers(customers: DataFrame, as_of: Column, observe: str | None = None) -> DataFrame:
    unique = customers if customers.isStreaming else drop_duplicate_keys(customers, ["customer_id"])
    cleaned = clean_customers(unique, as_of)
    return expect_all_or_drop(expect(cleaned, CUSTOMER_WARNINGS, observe), CUSTOMER_RULES)
