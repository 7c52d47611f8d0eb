"""Registered queries: aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.functions.scalars import percent
from stratalake.operators import skew, sketches
from stratalake.operators.dedup import duplicate_keys
from stratalake.plans import sales_metrics as sm
from stratalake.queries import entities as e
from stratalake.queries.entities import check
from stratalake.queries.registry import query
from stratalake.session import scratch_path


@query(
    "agg_count_filter_group",
    "SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 3000 GROUP BY 1",
)
def agg_count_filter_group(spark, sf):
    return e.load(spark, sf, "customer").where("c_acctbal > 3000").groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query(
    "agg_basic",
    check(
        "sales",
        """SELECT region, product_id, count(*) AS order_count, sum(revenue_usd) AS total_revenue,
             sum(unit_price) / count(*) AS avg_price FROM sales GROUP BY 1, 2""",
    ),
)
def agg_basic(spark, sf):
    return sm.region_product(e.sales(spark, sf))


@query("agg_distinct", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def agg_distinct(spark, sf):
    return e.load(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.countDistinct("l_partkey").alias("parts"))


@query(
    "agg_multi_distinct",
    """SELECT l_linestatus, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders, count(*) AS n
       FROM lineitem GROUP BY 1""",
)
def agg_multi_distinct(spark, sf):
    return e.load(spark, sf, "lineitem").groupBy("l_linestatus").agg(
        F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_orderkey").alias("orders"), F.count("*").alias("n")
    )


@query(
    "agg_approx_distinct",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, TRUE AS within_bound FROM lineitem GROUP BY 1",
)
def agg_approx_distinct(spark, sf):
    """The approximate count beside the exact one: off by at most five standard errors."""
    lines = e.load(spark, sf, "lineitem").groupBy("l_returnflag")
    exact = lines.agg(F.countDistinct("l_partkey").alias("parts"))
    near = lines.agg(F.approx_count_distinct("l_partkey", 0.02).alias("about"))
    within = F.abs(F.col("about") - F.col("parts")) <= 0.1 * F.col("parts")
    return exact.join(near, "l_returnflag").select("l_returnflag", "parts", within.alias("within_bound"))


@query(
    "agg_percentile",
    "SELECT o_orderpriority, quantile_disc(o_totalprice, 0.95) AS p95 FROM orders GROUP BY 1",
)
def agg_percentile(spark, sf):
    return e.load(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.percentile_approx("o_totalprice", 0.95, 1_000_000).alias("p95")
    )


@query(
    "agg_first_last",
    check(
        "readings",
        """SELECT "deviceId", arg_min(temperature, event_timestamp) AS first_temperature,
             arg_max(temperature, event_timestamp) AS last_temperature, min(event_timestamp) AS first_time,
             max(event_timestamp) AS last_time
           FROM readings GROUP BY 1""",
    ),
)
def agg_first_last(spark, sf):
    return e.readings(spark, sf).groupBy("deviceId").agg(
        F.min_by("temperature", "event_timestamp").alias("first_temperature"),
        F.max_by("temperature", "event_timestamp").alias("last_temperature"),
        F.min("event_timestamp").alias("first_time"),
        F.max("event_timestamp").alias("last_time"),
    )


@query(
    "agg_conditional",
    check(
        "ord",
        """SELECT payment_method, sum(CASE WHEN trim(lower(order_status)) = 'delivered' THEN total_amount ELSE 0 END)
             AS delivered_amount, count(*) FILTER (repeat_customer = 1) AS repeat_orders,
             count(CASE WHEN order_total > 250000 THEN 1 END) AS big_orders
           FROM ord GROUP BY 1""",
    ),
)
def agg_conditional(spark, sf):
    delivered = F.lower(F.trim("order_status")) == "delivered"
    return e.orders(spark, sf).groupBy("payment_method").agg(
        F.sum(F.when(delivered, F.col("total_amount")).otherwise(0)).alias("delivered_amount"),
        F.count_if(F.col("repeat_customer") == 1).alias("repeat_orders"),
        F.count(F.when(F.col("order_total") > 250000, 1)).alias("big_orders"),
    )


@query(
    "agg_ratio",
    check(
        "ord",
        """SELECT customer_id, n, round(r * 100.0::DOUBLE / n, 2) AS repeat_rate,
             round(r * 100.0::DOUBLE / nullif(n - r, 0), 2) AS repeat_to_new
           FROM (SELECT customer_id, count(*) AS n, count(*) FILTER (repeat_customer = 1) AS r FROM ord GROUP BY 1)""",
    ),
)
def agg_ratio(spark, sf):
    counts = e.orders(spark, sf).groupBy("customer_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("repeat_customer") == 1).alias("r")
    )
    return counts.select(
        "customer_id",
        "n",
        percent(F.col("r"), F.col("n")).alias("repeat_rate"),
        percent(F.col("r"), F.col("n") - F.col("r")).alias("repeat_to_new"),
    )


@query(
    "agg_range",
    check("readings", 'SELECT "deviceId", max(temperature) - min(temperature) AS temperature_range FROM readings GROUP BY 1'),
)
def agg_range(spark, sf):
    spread = (F.max("temperature") - F.min("temperature")).alias("temperature_range")
    return e.readings(spark, sf).groupBy("deviceId").agg(spread)


@query(
    "agg_global",
    check(
        "items",
        """SELECT count(*) AS n, max(bronze_loaded_ts_utc) AS last_change, max(line_total) AS largest,
             sum(line_total) / count(*) AS average FROM items""",
    ),
)
def agg_global(spark, sf):
    return e.items(spark, sf).agg(
        F.count("*").alias("n"),
        F.max("bronze_loaded_ts_utc").alias("last_change"),
        F.max("line_total").alias("largest"),
        F.avg("line_total").alias("average"),
    )


@query(
    "agg_duplicates",
    "SELECT l_orderkey, l_linenumber, count(*) AS duplicate_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def agg_duplicates(spark, sf):
    return duplicate_keys(e.load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "agg_expr_key",
    check(
        "ord",
        """SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(*) AS n, sum(total_amount) AS total
           FROM ord GROUP BY 1""",
    ),
)
def agg_expr_key(spark, sf):
    month = F.date_trunc("month", "order_date").cast("date").alias("month")
    return e.orders(spark, sf).groupBy(month).agg(F.count("*").alias("n"), F.sum("total_amount").alias("total"))


@query("agg_daily_metrics", check("daily", "SELECT * FROM daily"))
def agg_daily_metrics(spark, sf):
    return sm.sales_daily_metrics(e.orders(spark, sf), e.items(spark, sf))


@query("agg_category_perf", check("categories", "SELECT * FROM categories"))
def agg_category_perf(spark, sf):
    return sm.category_performance(e.items(spark, sf), e.products(spark, sf))


GEO = check(
    "ord customers",
    """SELECT time_bucket(INTERVAL 30 DAY, CAST(order_date AS TIMESTAMP), TIMESTAMP '1970-01-01') AS period_start,
         time_bucket(INTERVAL 30 DAY, CAST(order_date AS TIMESTAMP), TIMESTAMP '1970-01-01') + INTERVAL 30 DAY
           AS period_end, country, state, count(order_id) AS total_orders, sum(total_amount) AS total_revenue,
         sum(total_amount) / count(*) AS avg_order_value, count(DISTINCT customer_id) AS unique_customers,
         max(total_amount) AS max_order_value,
         sum(CASE WHEN trim(lower(order_status)) = 'delivered' THEN total_amount ELSE 0 END) AS delivered_revenue,
         sum(total_amount) / count(DISTINCT customer_id) AS revenue_per_customer
       FROM ord JOIN customers USING (customer_id) GROUP BY 1, 2, 3, 4""",
)


def _geo_orders(spark, sf):
    return e.orders(spark, sf).select(
        "order_id",
        "customer_id",
        F.col("order_date").cast("timestamp").alias("order_date"),
        F.col("total_amount").alias("order_total"),
        F.initcap(F.trim("order_status")).alias("order_status"),
    )


@query("agg_geo_period", GEO)
def agg_geo_period(spark, sf):
    return sm.geographic_sales(_geo_orders(spark, sf), e.customers(spark, sf))


@query(
    "agg_monthly_region",
    check(
        "sales",
        """SELECT region, CAST(date_trunc('month', event_date) AS DATE) AS month,
             count(DISTINCT customer_id) AS unique_customers, count(*) AS total_orders, sum(revenue_usd) AS total_revenue,
             sum(unit_price) / count(*) AS avg_unit_price FROM sales GROUP BY 1, 2""",
    ),
)
def agg_monthly_region(spark, sf):
    return sm.monthly_region(e.sales(spark, sf)).drop("p95_order_value")


@query(
    "skew_report",
    """SELECT max(n) AS max_count, sum(n) / count(*) AS avg_count, quantile_disc(n, 0.95) AS p95_count,
         max(n) / (sum(n) / count(*)) AS skew_ratio, max(n) / (sum(n) / count(*)) > 10 AS is_skewed
       FROM (SELECT CAST(count(*) AS DOUBLE) AS n
             FROM (SELECT CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE l_suppkey END AS k FROM lineitem) GROUP BY k)""",
)
def skew_report(spark, sf):
    k = F.when(F.col("l_orderkey") % 2 == 0, 1).otherwise(F.col("l_suppkey")).alias("k")
    return skew.skew_report(e.load(spark, sf, "lineitem").select(k), "k")


@query(
    "skew_top_keys",
    check("ord", "SELECT customer_id, count(*) AS order_count FROM ord GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
)
def skew_top_keys(spark, sf):
    return skew.top_keys(e.orders(spark, sf), "customer_id")


@query(
    "agg_weighted_cost",
    check(
        "usage",
        "SELECT workspace_id, sku_name, sum(usage_quantity * list_price) AS estimated_cost_usd FROM usage GROUP BY 1, 2",
    ),
)
def agg_weighted_cost(spark, sf):
    cost = F.sum(F.col("usage_quantity") * F.col("list_price")).alias("estimated_cost_usd")
    return e.usage(spark, sf).groupBy("workspace_id", "sku_name").agg(cost)


# -- dashboard -------------------------------------------------------------


def _daily(spark, sf):
    return sm.sales_daily_metrics(e.orders(spark, sf), e.items(spark, sf))


@query(
    "dash_kpi_month",
    check(
        "daily",
        "SELECT CAST(date_trunc('month', date) AS DATE) AS period, sum(total_revenue) AS total_revenue FROM daily GROUP BY 1",
    ),
)
def dash_kpi_month(spark, sf):
    return sm.kpi(_daily(spark, sf), "month", "total_revenue")


@query(
    "dash_kpi_month_avg",
    check(
        "daily",
        """SELECT CAST(date_trunc('month', date) AS DATE) AS period, round(avg(average_order_value), 3) AS average_order_value
           FROM daily GROUP BY 1""",
    ),
)
def dash_kpi_month_avg(spark, sf):
    kpi = sm.kpi(_daily(spark, sf), "month", "average_order_value", "avg")
    return kpi.withColumn("average_order_value", F.round("average_order_value", 3))


@query(
    "dash_kpi_week",
    check(
        "daily",
        """SELECT CAST(date_trunc('week', date) AS DATE) AS period, CAST(sum(total_orders) AS BIGINT) AS total_orders
           FROM daily GROUP BY 1""",
    ),
)
def dash_kpi_week(spark, sf):
    return sm.kpi(_daily(spark, sf), "week", "total_orders")


@query("dash_trend", check("daily", "SELECT date, total_orders FROM daily"))
def dash_trend(spark, sf):
    return sm.trend(_daily(spark, sf), "total_orders")


@query("dash_trend_value", check("daily", "SELECT date, average_order_value FROM daily"))
def dash_trend_value(spark, sf):
    return sm.trend(_daily(spark, sf), "average_order_value")


@query("dash_category", check("categories", "SELECT category, total_revenue FROM categories"))
def dash_category(spark, sf):
    return sm.category_bars(sm.category_performance(e.items(spark, sf), e.products(spark, sf)), "total_revenue")


@query("dash_category_units", check("categories", "SELECT category, total_units_sold FROM categories"))
def dash_category_units(spark, sf):
    return sm.category_bars(sm.category_performance(e.items(spark, sf), e.products(spark, sf)), "total_units_sold")


# -- periods from stored sketches --------------------------------------------


@query(
    "dash_customers_period",
    """SELECT kind, CAST(date_trunc(kind, o_orderdate) AS DATE) AS period, count(*) AS orders,
         CAST(sum(round(o_totalprice * 100)) AS BIGINT) AS cents, TRUE AS customers_close, TRUE AS median_close
       FROM orders, (VALUES ('week'), ('month'), ('year')) v(kind) GROUP BY 1, 2""",
)
def dash_customers_period(spark, sf):
    """Orders, revenue, customers and median order of weeks, months and years, all from one stored
    table of days; estimates are held against the exact values."""
    orders, path = e.load(spark, sf, "orders"), scratch_path(spark, "daily-sketches")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    day = F.to_date("o_orderdate")
    sketches.daily_sketches(
        orders, day, [], {"cents": cents}, {"customers": F.col("o_custkey")}, {"price": F.col("o_totalprice")}
    ).write.parquet(path)
    daily, out = spark.read.parquet(path), None
    for kind in ("week", "month", "year"):
        found = sketches.read_off(sketches.roll_up(daily, F.date_trunc(kind, "day").cast("date"), []), {"median": ("price", 0.5)})
        found = found.select("day", "n_rows", "cents", "customers", "median")
        exact = orders.select(F.date_trunc(kind, day).cast("date").alias("day"), "o_custkey", "o_totalprice")
        people = exact.groupBy("day").agg(F.count_distinct("o_custkey").alias("people"))
        places = exact.join(found.select("day", "median"), "day").groupBy("day").agg(
            F.avg((F.col("o_totalprice") < F.col("median")).cast("int")).alias("below"),
            F.avg((F.col("o_totalprice") <= F.col("median")).cast("int")).alias("upto"),
        )
        facts = found.join(people, "day").join(places, "day").select(
            F.lit(kind).alias("kind"),
            F.col("day").alias("period"),
            F.col("n_rows").alias("orders"),
            "cents",
            (F.abs(F.col("customers") - F.col("people")) <= 0.05 * F.col("people")).alias("customers_close"),
            ((F.col("below") <= 0.55) & (F.col("upto") >= 0.45)).alias("median_close"),
        )
        out = facts if out is None else out.unionByName(facts)
    return out
