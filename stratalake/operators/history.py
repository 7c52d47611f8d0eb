"""Order-history features: next, previous and running values per customer.

All six features share one partitioning and one order, so the plain form costs one
exchange and one sort. A customer with a large share of all orders would still be sorted
by one task; `order_features` therefore cuts hot customers into ranges of the order key,
computes each range on its own and adds what the ranges before it carry over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.joins import BROADCAST_ROWS, hot_keys
from stratalake.operators.ranges import range_of, sample_bounds
from stratalake.session import scratch_path

KEY, DAY, ORDER, AMOUNT = "customer_id", "order_date", "order_id", "order_amount"
HOT_ROWS = 5_000_000


def _w() -> Window:
    return Window.partitionBy(KEY).orderBy(F.col(DAY), F.col(ORDER))


def _before() -> Window:
    return _w().rowsBetween(Window.unboundedPreceding, -1)


def plain_features() -> dict[str, Column]:
    return {
        "label_next_order_amount": F.lead(AMOUNT).over(_w()),
        "last_order_amount": F.lag(AMOUNT).over(_w()),
        "days_since_prev_order": F.datediff(F.col(DAY), F.lag(DAY).over(_w())).cast("int"),
        "purchase_count_to_date": F.count(F.lit(1)).over(_before()).cast("int"),
        "hist_avg_purchase": F.avg(AMOUNT).over(_before()),
        "total_spend_to_date": F.sum(AMOUNT).over(_before()),
    }


def add_label_next_order_amount(df: DataFrame) -> DataFrame:
    return order_features(df, ["label_next_order_amount"])


def add_last_order_amount(df: DataFrame) -> DataFrame:
    return order_features(df, ["last_order_amount"])


def add_days_since_prev_order(df: DataFrame) -> DataFrame:
    return order_features(df, ["days_since_prev_order"])


def add_purchase_count_to_date(df: DataFrame) -> DataFrame:
    return order_features(df, ["purchase_count_to_date"])


def add_hist_avg_purchase(df: DataFrame) -> DataFrame:
    return order_features(df, ["hist_avg_purchase"])


def add_total_spend_to_date(df: DataFrame) -> DataFrame:
    return order_features(df, ["total_spend_to_date"])


def order_features(df: DataFrame, features: list[str] | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add the named features (all six by default), whatever the size of a customer.

    Customers with more than `hot_rows` orders are found by a pre-aggregated count over
    the key column. Without any, the plain windows run unchanged.
    """
    plain = plain_features()
    wanted = list(plain) if features is None else features
    hot = hot_keys(df, [KEY], hot_rows)
    n_hot = hot.count()
    if n_hot == 0:
        return df.select("*", *[plain[f].alias(f) for f in wanted])
    keys = hot.select(KEY)
    out = _split_features(df, F.broadcast(keys) if n_hot <= BROADCAST_ROWS else keys, wanted, hot_rows)
    # one schema, whether a customer is hot or not
    kinds = df.limit(0).select(*[plain[f].alias(f) for f in wanted]).schema
    return out.select(*df.columns, *[F.col(f.name).cast(f.dataType) for f in kinds])


def _split_features(df: DataFrame, hot: DataFrame, wanted: list[str], hot_rows: int) -> DataFrame:
    path = scratch_path(df.sparkSession, "hot-orders")
    df.join(hot, KEY, "left_semi").select(*df.columns).write.parquet(path)  # read several times below
    big = df.sparkSession.read.schema(df.schema).parquet(path)
    small = df.join(hot, KEY, "left_anti").select(*df.columns, *[plain_features()[f].alias(f) for f in wanted])

    rows = big.count()
    bounds = sample_bounds(big, [DAY, ORDER], 2 + 4 * rows // hot_rows, rows)
    cut = big.withColumn("__r", range_of(big, [DAY, ORDER], bounds))
    w = Window.partitionBy(KEY, "__r").orderBy(F.col(DAY), F.col(ORDER))
    before = w.rowsBetween(Window.unboundedPreceding, -1)

    # one row per (hot customer, range): what the neighbouring ranges need to know
    position = F.struct(F.col(DAY), F.col(ORDER))
    carried = F.struct(F.col(AMOUNT), F.col(DAY))
    edges = cut.groupBy(KEY, "__r").agg(
        F.min_by(carried, position).alias("first"),
        F.max_by(carried, position).alias("last"),
        F.count(F.lit(1)).alias("n"),
        F.count(AMOUNT).alias("n_amount"),
        F.sum(AMOUNT).alias("total"),
    )
    over = Window.partitionBy(KEY).orderBy("__r")
    so_far = over.rowsBetween(Window.unboundedPreceding, -1)
    carry = edges.select(
        KEY,
        "__r",
        F.lag("last").over(over).alias("__prev"),
        F.lead("first").over(over).alias("__next"),
        F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("__n"),
        F.coalesce(F.sum("n_amount").over(so_far), F.lit(0)).alias("__na"),
        F.sum("total").over(so_far).alias("__total"),
    )

    local = cut.select(
        "*",
        F.row_number().over(w).alias("__pos"),
        F.lead(F.lit(1)).over(w).alias("__more"),
        F.lead(AMOUNT).over(w).alias("__lead"),
        F.lag(AMOUNT).over(w).alias("__lag"),
        F.lag(DAY).over(w).alias("__lag_day"),
        F.count(F.lit(1)).over(before).alias("__ln"),
        F.count(AMOUNT).over(before).alias("__lna"),
        F.sum(AMOUNT).over(before).alias("__ltotal"),
    ).join(carry, [KEY, "__r"])

    is_first, is_last = F.col("__pos") == 1, F.col("__more").isNull()
    spent = F.when(
        F.col("__total").isNotNull() | F.col("__ltotal").isNotNull(),
        F.coalesce(F.col("__total"), F.lit(0)) + F.coalesce(F.col("__ltotal"), F.lit(0)),
    )
    prev_day = F.when(is_first, F.col(f"__prev.{DAY}")).otherwise(F.col("__lag_day"))
    values = {
        "label_next_order_amount": F.when(is_last, F.col(f"__next.{AMOUNT}")).otherwise(F.col("__lead")),
        "last_order_amount": F.when(is_first, F.col(f"__prev.{AMOUNT}")).otherwise(F.col("__lag")),
        "days_since_prev_order": F.datediff(F.col(DAY), prev_day).cast("int"),
        "purchase_count_to_date": (F.col("__n") + F.col("__ln")).cast("int"),
        "hist_avg_purchase": F.try_divide(spent, F.col("__na") + F.col("__lna")),
        "total_spend_to_date": spent,
    }
    return local.select(*df.columns, *[values[f].alias(f) for f in wanted]).unionByName(small)
