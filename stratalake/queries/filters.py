"""Registered queries: projection, filter, condition."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.functions.scalars import alert_message, alert_severity, alert_type, order_value_band, tenure_band
from stratalake.queries import entities as e
from stratalake.queries.entities import check
from stratalake.queries.registry import query


@query("prj_select_alias", check("customers", "SELECT customer_id AS id, name AS customer_name, country AS region FROM customers"))
def prj_select_alias(spark, sf):
    return e.customers(spark, sf).select(
        F.col("customer_id").alias("id"), F.col("name").alias("customer_name"), F.col("country").alias("region")
    )


@query(
    "prj_derived",
    check(
        "items",
        """SELECT order_item_id, product_id, bronze_loaded_ts_utc, quantity * unit_price AS total_amount,
             year(bronze_loaded_ts_utc) AS sale_year, month(bronze_loaded_ts_utc) AS sale_month FROM items""",
    ),
)
def prj_derived(spark, sf):
    sold = F.col("bronze_loaded_ts_utc")
    return e.items(spark, sf).select(
        "order_item_id",
        "product_id",
        sold,
        (F.col("quantity") * F.col("unit_price")).alias("total_amount"),
        F.year(sold).alias("sale_year"),
        F.month(sold).alias("sale_month"),
    )


@query(
    "prj_cast",
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_totalprice AS INTEGER) AS whole_total,
         CAST(o_orderdate AS DATE) AS order_date, CAST(o_custkey AS DOUBLE) AS customer_number,
         TRY_CAST(o_orderpriority AS INTEGER) AS not_a_number
       FROM (SELECT * REPLACE (floor(o_totalprice) AS o_totalprice) FROM orders)""",
)
def prj_cast(spark, sf):
    return e.load(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.floor("o_totalprice").cast("int").alias("whole_total"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_custkey").cast("double").alias("customer_number"),
        F.col("o_orderpriority").try_cast("int").alias("not_a_number"),
    )


@query("prj_drop_rename", "SELECT * EXCLUDE (l_tax, l_discount) RENAME (l_partkey AS product_id) FROM lineitem")
def prj_drop_rename(spark, sf):
    return e.load(spark, sf, "lineitem").drop("l_tax", "l_discount").withColumnRenamed("l_partkey", "product_id")


@query(
    "prj_struct_flatten",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, user_id AS device,
         value AS reading FROM events""",
)
def prj_struct_flatten(spark, sf):
    nested = e.load(spark, sf, "events").select(
        "event_id",
        F.from_json("props", "k INT").alias("props"),
        F.struct(F.col("user_id").alias("device"), F.struct(F.col("value").alias("reading")).alias("data")).alias("event"),
    )
    return nested.select("event_id", "props.k", "event.device", "event.data.reading")


@query(
    "prj_selectexpr",
    "SELECT o_orderkey AS order_id, o_totalprice * 2 AS doubled, upper(o_orderpriority) AS priority FROM orders",
)
def prj_selectexpr(spark, sf):
    return e.load(spark, sf, "orders").selectExpr(
        "o_orderkey AS order_id", "o_totalprice * 2 AS doubled", "upper(o_orderpriority) AS priority"
    )


@query(
    "flt_compare",
    """SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
       WHERE o_totalprice > 100000 AND o_totalprice <= 300000 AND o_orderdate >= TIMESTAMP '1997-01-01'
         AND o_orderstatus = 'O'""",
)
def flt_compare(spark, sf):
    price = F.col("o_totalprice")
    since = F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")
    return (
        e.load(spark, sf, "orders")
        .where((price > 100000) & (price <= 300000) & since & (F.col("o_orderstatus") == "O"))
        .select("o_orderkey", "o_totalprice", "o_orderdate")
    )


@query(
    "flt_null",
    check(
        "raw_sales",
        "SELECT event_id, customer_id, quantity FROM raw_sales WHERE event_id IS NULL OR customer_id IS NULL OR quantity IS NULL",
    ),
)
def flt_null(spark, sf):
    missing = F.col("event_id").isNull() | F.col("customer_id").isNull() | F.col("quantity").isNull()
    return e.raw_sales(spark, sf).where(missing).select("event_id", "customer_id", "quantity")


@query("flt_in", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def flt_in(spark, sf):
    wanted = F.col("o_orderpriority").isin("1-URGENT", "5-LOW")
    return e.load(spark, sf, "orders").where(wanted).select("o_orderkey", "o_orderpriority")


@query("flt_like", check("usage", "SELECT sku_name, usage_start_time FROM usage WHERE sku_name LIKE '%JOBS%'"))
def flt_like(spark, sf):
    return e.usage(spark, sf).where(F.col("sku_name").like("%JOBS%")).select("sku_name", "usage_start_time")


@query("flt_sql_text", "SELECT user_id, count(*) AS cnt FROM events GROUP BY 1 HAVING count(*) > 60")
def flt_sql_text(spark, sf):
    return e.load(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 60")


@query(
    "flt_relative_time",
    f"SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '{e.AS_OF}' - INTERVAL 7 DAY",
)
def flt_relative_time(spark, sf):
    events = e.load(spark, sf, "events")
    since = F.lit(e.AS_OF).cast("timestamp_ntz") - F.expr("INTERVAL 7 DAYS")
    return events.where(F.col("ts") > since).select("event_id", "ts")


@query(
    "flt_scalar_subquery",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)",
)
def flt_scalar_subquery(spark, sf):
    orders = e.load(spark, sf, "orders")
    latest = orders.agg(F.max("o_orderdate")).scalar()
    return orders.where(F.col("o_orderdate") == latest).select("o_orderkey", "o_orderdate")


@query(
    "flt_having",
    check("ord", "SELECT customer_id, count(*) AS n_orders FROM ord GROUP BY 1 HAVING count(*) > 12"),
)
def flt_having(spark, sf):
    return e.orders(spark, sf).groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_orders")).where("n_orders > 12")


@query(
    "cnd_case",
    check(
        "ord",
        """SELECT order_id, CASE WHEN t < 500 THEN 'Low' WHEN t < 1500 THEN 'Medium' WHEN t < 2500 THEN 'High'
             ELSE 'Premium' END AS order_value_category
           FROM (SELECT order_id, CASE WHEN order_id % 40 <> 0 THEN order_total / 100 END AS t FROM ord)""",
    ),
)
def cnd_case(spark, sf):
    total = F.when(F.col("order_id") % 40 != 0, F.col("order_total") / 100)
    return e.orders(spark, sf).select("order_id", order_value_band(total).alias("order_value_category"))


@query(
    "cnd_tenure",
    check(
        "customers",
        """SELECT customer_id, CASE WHEN d < 180 THEN 'New' WHEN d < 365 THEN 'Growing' WHEN d < 730 THEN 'Established'
             ELSE 'Loyal' END AS customer_tenure_segment
           FROM (SELECT customer_id, CASE WHEN customer_id % 40 <> 0
                   THEN date_diff('day', signup_date, DATE '2024-01-31') END AS d FROM customers)""",
    ),
)
def cnd_tenure(spark, sf):
    days = F.when(F.col("customer_id") % 40 != 0, F.datediff(F.lit(e.AS_OF).cast("date"), F.col("signup_date")))
    return e.customers(spark, sf).select("customer_id", tenure_band(days).alias("customer_tenure_segment"))


ALERT_SQL = """CASE WHEN temperature > 35 THEN 'CRITICAL_TEMPERATURE' WHEN temperature > 30 THEN 'HIGH_TEMPERATURE'
    WHEN battery < 10 THEN 'CRITICAL_BATTERY' WHEN battery < 20 THEN 'LOW_BATTERY' ELSE 'NORMAL' END AS alert_type"""
MESSAGE_SQL = """CASE alert_type WHEN 'CRITICAL_TEMPERATURE' THEN 'Critical temperature detected: ' || temperature || '°C'
    WHEN 'HIGH_TEMPERATURE' THEN 'High temperature warning: ' || temperature || '°C'
    WHEN 'CRITICAL_BATTERY' THEN 'Critical battery level: ' || battery || '%'
    WHEN 'LOW_BATTERY' THEN 'Low battery warning: ' || battery || '%' ELSE 'Normal operation' END AS alert_message"""
SEVERITY_SQL = """CASE WHEN alert_type IN ('CRITICAL_TEMPERATURE', 'CRITICAL_BATTERY') THEN 'CRITICAL'
    WHEN alert_type IN ('HIGH_TEMPERATURE', 'LOW_BATTERY') THEN 'WARNING' ELSE 'NORMAL' END AS severity"""


@query("cnd_alert", check("readings", f"SELECT \"deviceId\", event_timestamp, temperature, battery, {ALERT_SQL} FROM readings"))
def cnd_alert(spark, sf):
    return e.readings(spark, sf).withColumn("alert_type", alert_type("temperature", "battery"))


@query(
    "cnd_message",
    check("readings", f", r AS (SELECT *, {ALERT_SQL} FROM readings) SELECT *, {MESSAGE_SQL} FROM r"),
)
def cnd_message(spark, sf):
    typed = e.readings(spark, sf).withColumn("alert_type", alert_type("temperature", "battery"))
    return typed.withColumn("alert_message", alert_message("alert_type", "temperature", "battery"))


@query(
    "cnd_severity",
    check(
        "readings",
        f""", r AS (SELECT *, {ALERT_SQL} FROM readings)
        SELECT "deviceId", event_timestamp, alert_type, {SEVERITY_SQL} FROM r WHERE alert_type <> 'NORMAL'""",
    ),
)
def cnd_severity(spark, sf):
    typed = e.readings(spark, sf).withColumn("alert_type", alert_type("temperature", "battery"))
    return typed.where("alert_type <> 'NORMAL'").select(
        "deviceId", "event_timestamp", "alert_type", alert_severity("alert_type").alias("severity")
    )


CTE_BODY = """busy AS (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey),
    ranked AS (SELECT n_orders, count(*) AS n_customers FROM busy GROUP BY n_orders)
    SELECT r.n_orders, r.n_customers, d.n_total FROM ranked r
    JOIN (SELECT n_orders, n_orders * n_customers AS n_total FROM ranked) d ON r.n_orders = d.n_orders"""


@query("cte", f"WITH {CTE_BODY}")
def cte(spark, sf):
    return spark.sql(
        f"WITH orders AS (SELECT * FROM {{orders_in}}), {CTE_BODY}", orders_in=e.load(spark, sf, "orders")
    )
