"""The test tables seen as the entities the operators work on.

Each entity exists twice, as a DataFrame and as check SQL. Amounts that are summed are
held in minor units (integral DOUBLEs), so sums are exact in any order of addition. NULLs
and untidy text are derived from row numbers, since the tables have none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31"


def load(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def as_of() -> Column:
    """The tables hold timestamps without zone; comparing like with like lets the filter
    reach the scan."""
    return F.lit(AS_OF).cast("timestamp_ntz")


def minor(c: str) -> Column:
    """An amount in minor units."""
    return F.round(F.col(c) * 100)


def customers(spark: SparkSession, sf: str) -> DataFrame:
    c, n, r = (load(spark, sf, t) for t in ("customer", "nation", "region"))
    k = F.col("c_custkey")
    return (
        c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            k.alias("customer_id"),
            F.col("c_name").alias("name"),
            F.when(k % 50 == 1, F.lit("no-address"))
            .when(k % 77 == 1, F.lit(None))
            .otherwise(F.concat(F.lit("user"), k.cast("string"), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example")))
            .alias("email"),
            F.concat(F.lit("+1 (555) "), (k + 1000000).cast("string")).alias("phone"),
            F.col("n_name").alias("city"),
            F.col("n_name").alias("state"),
            F.col("r_name").alias("country"),
            F.col("c_mktsegment").alias("segment"),
            F.date_add(F.lit("2019-01-01").cast("date"), (k * 7 % 2400).cast("int")).alias("signup_date"),
            F.col("c_acctbal").alias("balance"),
        )
    )


def order_status() -> Column:
    return (
        F.when(F.col("o_orderkey") % 10 == 0, " cancelled")
        .when(F.col("o_orderstatus") == "F", "delivered ")
        .when(F.col("o_orderstatus") == "O", " SHIPPED")
        .otherwise("Pending")
    )


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderpriority").alias("payment_method"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"), 1).otherwise(0).alias("repeat_customer"),
        minor("o_totalprice").alias("total_amount"),
        F.col("o_totalprice").alias("order_total"),
        order_status().alias("order_status"),
    )


def items(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        minor("l_extendedprice").alias("line_total"),
        F.col("l_shipdate").cast("timestamp").alias("bronze_loaded_ts_utc"),
    )


def products(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("p_retailprice").alias("price"),
    )


def _padded(c: str) -> Column:
    return F.concat(F.lit("  "), F.col(c).cast("string"), F.lit(" "))


def _loads(df: DataFrame, again: Column, changes: dict[str, Column]) -> DataFrame:
    """A first load of every row and a second one of some, with changed columns."""
    first = df.withColumn("bronze_loaded_ts_utc", F.lit("2024-01-01").cast("timestamp"))
    second = df.where(again).withColumns(changes)
    return first.unionByName(second.withColumn("bronze_loaded_ts_utc", F.lit("2024-01-02").cast("timestamp")))


def bronze_customers(spark: SparkSession, sf: str) -> DataFrame:
    df = customers(spark, sf).select(
        _padded("customer_id").alias("customer_id"),
        F.concat(F.lit(" "), F.upper("email")).alias("email"),
        _padded("name").alias("name"),
        "city",
        "state",
        "country",
        F.col("signup_date").cast("string").alias("signup_date"),
        F.lit("landing").alias("source_file"),
    )
    return _loads(df, F.col("customer_id").endswith("7 "), {"city": F.lit("Moved")})


def bronze_orders(spark: SparkSession, sf: str) -> DataFrame:
    df = orders(spark, sf).select(
        _padded("order_id").alias("order_id"),
        _padded("customer_id").alias("customer_id"),
        F.col("order_date").cast("string").alias("order_date"),
        F.col("order_total").cast("string").alias("order_total"),
        "order_status",
        F.lit("landing").alias("source_file"),
    )
    return _loads(df, F.col("order_id").endswith("3 "), {"order_total": F.lit("1.5")})


def bronze_products(spark: SparkSession, sf: str) -> DataFrame:
    df = products(spark, sf).select(
        _padded("product_id").alias("product_id"),
        _padded("product_name").alias("product_name"),
        _padded("category").alias("category"),
        "subcategory",
        F.col("price").cast("string").alias("price"),
        F.lit("landing").alias("source_file"),
    )
    return _loads(df, F.col("product_id").endswith("9 "), {"price": F.lit("2.25")})


def bronze_items(spark: SparkSession, sf: str) -> DataFrame:
    return items(spark, sf).select(
        _padded("order_item_id").alias("order_item_id"),
        _padded("order_id").alias("order_id"),
        _padded("product_id").alias("product_id"),
        F.col("quantity").cast("string").alias("quantity"),
        F.col("unit_price").cast("string").alias("unit_price"),
        F.lit("landing").alias("source_file"),
        "bronze_loaded_ts_utc",
    )


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """Device readings: whole degrees and whole percents."""
    return readings_of(load(spark, sf, "events"))


def readings_of(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").alias("deviceId"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.floor("value").cast("double").alias("temperature"),
        (F.col("event_id") % 100).cast("double").alias("battery"),
    )


def raw_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Sales events with NULL keys, bad amounts and untidy currency codes."""
    i = F.col("event_id")
    return load(spark, sf, "events").select(
        F.when(i % 101 != 0, i.cast("string")).alias("event_id"),
        F.when(i % 103 != 0, F.col("user_id").cast("string")).alias("customer_id"),
        F.col("event_type").alias("product_id"),
        F.when(i % 97 == 0, F.lit(None))
        .when(i % 89 == 0, 0)
        .when(i % 83 == 0, -1)
        .otherwise((i % 10 + 1).cast("int"))
        .alias("quantity"),
        F.when(i % 79 == 0, 0.0).otherwise(F.col("value")).alias("unit_price"),
        F.when(i % 6 == 0, " eur ")
        .when(i % 6 == 1, "GBP")
        .when(i % 6 == 2, "cad")
        .when(i % 6 == 3, "JPY")
        .when(i % 6 == 4, F.lit(None))
        .otherwise("USD")
        .alias("currency"),
        F.when(i % 3 == 0, " us").when(i % 3 == 1, "EU ").otherwise("apac").alias("region"),
        F.when(i % 107 != 0, F.col("ts").cast("timestamp")).alias("event_timestamp"),
        F.lit("web").alias("source_system"),
    )


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """Clean sales by region and product, amounts in minor units."""
    i = F.col("event_id")
    return load(spark, sf, "events").select(
        i.alias("event_id"),
        F.when(i % 5 < 3, "US").when(i % 5 == 3, "EU").otherwise("APAC").alias("region"),
        F.col("event_type").alias("product_id"),
        F.col("user_id").alias("customer_id"),
        minor("value").alias("revenue_usd"),
        F.floor("value").cast("double").alias("unit_price"),
        F.col("ts").cast("date").alias("event_date"),
    )


def _workspace() -> Column:
    return F.concat(F.lit("ws"), (F.col("user_id") % 3).cast("string"))


def _result() -> Column:
    return (
        F.when(F.col("event_type") == "error", "FAILED")
        .when(F.col("event_type") == "signup", F.lit(None))
        .when(F.col("event_type") == "view", "CANCELLED")
        .otherwise("SUCCEEDED")
    )


def _ends() -> Column:
    return F.col("ts") + F.make_dt_interval(secs=F.floor("value").cast("decimal(18,6)"))


def jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Job definitions, one row per change of a job; some under ids that no run has."""
    changes = load(spark, sf, "events")
    return changes.select(
        _workspace().alias("workspace_id"),
        F.when(F.col("user_id") % 5 == 0, -F.col("user_id")).otherwise(F.col("user_id")).alias("job_id"),
        F.concat_ws("-", F.lit("job"), "user_id", "event_id").alias("name"),
        F.col("ts").alias("change_time"),
    )


def job_names(spark: SparkSession, sf: str) -> DataFrame:
    """One row per job."""
    return load(spark, sf, "events").select(F.col("user_id").alias("job_id")).distinct().select(
        "job_id", F.concat_ws("-", F.lit("job"), "job_id").alias("name")
    )


def job_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Job definitions with a row per change, several for most jobs."""
    return load(spark, sf, "events").select(
        F.col("user_id").alias("job_id"),
        F.concat_ws("-", F.lit("job"), "user_id", F.col("event_id") % 3).alias("name"),
        F.col("ts").alias("change_time"),
    )


def job_run_timeline(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").select(
        _workspace().alias("workspace_id"),
        F.col("user_id").alias("job_id"),
        F.col("event_id").alias("run_id"),
        _result().alias("result_state"),
        F.col("ts").alias("period_start_time"),
        _ends().alias("period_end_time"),
    )


def job_runs(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").select(
        F.col("user_id").alias("job_id"),
        F.col("event_id").alias("run_id"),
        _result().alias("result_state"),
        F.col("ts").alias("start_time"),
        _ends().alias("end_time"),
        F.when(F.col("event_id") % 2 == 0, "PERIODIC").otherwise("MANUAL").alias("trigger_type"),
        F.concat(F.lit("state of "), F.col("event_id").cast("string")).alias("state_message"),
    )


def usage(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("user_id")
    return load(spark, sf, "events").select(
        _workspace().alias("workspace_id"),
        F.lit("CLOUD").alias("cloud"),
        F.concat(
            F.upper("event_type"), F.when(F.col("event_type") == "view", "_SQL").otherwise("_JOBS")
        ).alias("sku_name"),
        F.when(F.col("event_id") % 4 == 0, "STORAGE").otherwise("COMPUTE_TIME").alias("usage_type"),
        F.col("ts").cast("date").alias("usage_date"),
        F.col("ts").alias("usage_start_time"),
        _ends().alias("usage_end_time"),
        F.floor("value").cast("double").alias("usage_quantity"),
        (F.col("event_id") % 3 + 1).cast("double").alias("list_price"),
        F.concat_ws("-", F.lit("cluster"), (u % 40).cast("string")).alias("cluster_id"),
        F.concat_ws(" ", F.lit("Cluster"), (u % 40).cast("string")).alias("cluster_name"),
        F.struct(
            F.struct(
                F.concat(F.lit("team"), (u % 4).cast("string")).alias("Team"),
                F.concat(F.lit("project"), (u % 6).cast("string")).alias("Project"),
            ).alias("cluster_tags"),
            F.when(u % 5 != 0, F.concat_ws("-", F.lit("job"), u.cast("string"))).alias("job_name"),
        ).alias("usage_metadata"),
        F.when(u % 2 == 0, "JOBS").otherwise("SQL").alias("billing_origin_product"),
    )


def long_usage(spark: SparkSession, sf: str) -> DataFrame:
    """The usage, moved up to five months later."""
    later = F.make_ym_interval(F.lit(0), (F.col("usage_quantity") % 6).cast("int"))
    moved = {c: F.col(c) + later for c in ("usage_start_time", "usage_end_time")}
    return usage(spark, sf).withColumns(moved)


def list_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Three price periods per product; the last one is open."""
    skus = usage(spark, sf).select("cloud", "sku_name").distinct()
    # fixed values: period starts, ends and prices
    periods = F.array(
        *[
            F.struct(
                F.lit(a).cast("timestamp_ntz").alias("price_start_time"),
                F.lit(b).cast("timestamp_ntz").alias("price_end_time"),
                F.lit(p).alias("p"),
            )
            for a, b, p in [
                ("2023-06-01", "2024-01-10", 2.0),
                ("2024-01-10", "2024-01-20", 3.0),
                ("2024-01-20", None, 5.0),
            ]
        ]
    )
    return skus.select("cloud", "sku_name", F.explode(periods).alias("x")).select(
        "cloud",
        "sku_name",
        "x.price_start_time",
        "x.price_end_time",
        F.struct(
            F.col("x.p").alias("default"), F.struct((F.col("x.p") * 2).alias("default")).alias("effective_list")
        ).alias("pricing"),
    )


def maintenance_ops(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").select(
        F.upper("event_type").alias("operation_type"),
        (F.floor("value") * 1000000).alias("optimized_files_size_bytes"),
        F.col("ts").alias("operation_timestamp"),
    )


# -- the same entities as check SQL ----------------------------------------

SQL = {
    "customers": """
        SELECT c_custkey AS customer_id, c_name AS name,
          CASE WHEN c_custkey % 50 = 1 THEN 'no-address' WHEN c_custkey % 77 = 1 THEN NULL
               ELSE 'user' || c_custkey || '@' || lower(c_mktsegment) || '.example' END AS email,
          '+1 (555) ' || (c_custkey + 1000000) AS phone,
          n_name AS city, n_name AS state, r_name AS country, c_mktsegment AS segment,
          DATE '2019-01-01' + CAST(c_custkey * 7 % 2400 AS INTEGER) AS signup_date, c_acctbal AS balance
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "ord": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
          o_orderpriority AS payment_method,
          CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 1 ELSE 0 END AS repeat_customer,
          round(o_totalprice * 100) AS total_amount, o_totalprice AS order_total,
          CASE WHEN o_orderkey % 10 = 0 THEN ' cancelled' WHEN o_orderstatus = 'F' THEN 'delivered '
               WHEN o_orderstatus = 'O' THEN ' SHIPPED' ELSE 'Pending' END AS order_status
        FROM orders""",
    "items": """
        SELECT l_orderkey || '-' || l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
          CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS unit_price,
          round(l_extendedprice * 100) AS line_total, l_shipdate AS bronze_loaded_ts_utc
        FROM lineitem""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS subcategory,
          p_retailprice AS price
        FROM part""",
    "readings": """
        SELECT CAST(user_id AS VARCHAR) AS "deviceId", ts AS event_timestamp,
          CAST(floor(value) AS DOUBLE) AS temperature, CAST(event_id % 100 AS DOUBLE) AS battery
        FROM events""",
    "raw_sales": """
        SELECT CASE WHEN event_id % 101 <> 0 THEN CAST(event_id AS VARCHAR) END AS event_id,
          CASE WHEN event_id % 103 <> 0 THEN CAST(user_id AS VARCHAR) END AS customer_id,
          event_type AS product_id,
          CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 0 WHEN event_id % 83 = 0 THEN -1
               ELSE CAST(event_id % 10 + 1 AS INTEGER) END AS quantity,
          CASE WHEN event_id % 79 = 0 THEN 0.0 ELSE value END AS unit_price,
          CASE event_id % 6 WHEN 0 THEN ' eur ' WHEN 1 THEN 'GBP' WHEN 2 THEN 'cad' WHEN 3 THEN 'JPY'
               WHEN 4 THEN NULL ELSE 'USD' END AS currency,
          CASE event_id % 3 WHEN 0 THEN ' us' WHEN 1 THEN 'EU ' ELSE 'apac' END AS region,
          CASE WHEN event_id % 107 <> 0 THEN ts END AS event_timestamp, 'web' AS source_system
        FROM events""",
    "sales": """
        SELECT event_id, CASE WHEN event_id % 5 < 3 THEN 'US' WHEN event_id % 5 = 3 THEN 'EU' ELSE 'APAC' END AS region,
          event_type AS product_id, user_id AS customer_id, round(value * 100) AS revenue_usd,
          CAST(floor(value) AS DOUBLE) AS unit_price, CAST(ts AS DATE) AS event_date
        FROM events""",
    "jobs": """
        SELECT 'ws' || (user_id % 3) AS workspace_id, CASE WHEN user_id % 5 = 0 THEN -user_id ELSE user_id END AS job_id,
          'job-' || user_id || '-' || event_id AS name, ts AS change_time
        FROM events""",
    "job_versions": """SELECT user_id AS job_id, 'job-' || user_id || '-' || (event_id % 3) AS name, ts AS change_time
        FROM events""",
    "job_names": "SELECT DISTINCT user_id AS job_id, 'job-' || user_id AS name FROM events",
    "timeline": """
        SELECT 'ws' || (user_id % 3) AS workspace_id, user_id AS job_id, event_id AS run_id,
          CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN NULL WHEN 'view' THEN 'CANCELLED'
               ELSE 'SUCCEEDED' END AS result_state,
          ts AS period_start_time, ts + to_seconds(CAST(floor(value) AS BIGINT)) AS period_end_time
        FROM events""",
    "runs": """
        SELECT user_id AS job_id, event_id AS run_id,
          CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN NULL WHEN 'view' THEN 'CANCELLED'
               ELSE 'SUCCEEDED' END AS result_state,
          ts AS start_time, ts + to_seconds(CAST(floor(value) AS BIGINT)) AS end_time,
          CASE WHEN event_id % 2 = 0 THEN 'PERIODIC' ELSE 'MANUAL' END AS trigger_type,
          'state of ' || event_id AS state_message
        FROM events""",
    "usage": """
        SELECT 'ws' || (user_id % 3) AS workspace_id, 'CLOUD' AS cloud,
          upper(event_type) || CASE WHEN event_type = 'view' THEN '_SQL' ELSE '_JOBS' END AS sku_name,
          CASE WHEN event_id % 4 = 0 THEN 'STORAGE' ELSE 'COMPUTE_TIME' END AS usage_type,
          CAST(ts AS DATE) AS usage_date, ts AS usage_start_time,
          ts + to_seconds(CAST(floor(value) AS BIGINT)) AS usage_end_time,
          CAST(floor(value) AS DOUBLE) AS usage_quantity, CAST(event_id % 3 + 1 AS DOUBLE) AS list_price,
          'cluster-' || (user_id % 40) AS cluster_id, 'Cluster ' || (user_id % 40) AS cluster_name,
          'team' || (user_id % 4) AS team, 'project' || (user_id % 6) AS project,
          CASE WHEN user_id % 5 <> 0 THEN 'job-' || user_id END AS job_name,
          CASE WHEN user_id % 2 = 0 THEN 'JOBS' ELSE 'SQL' END AS billing_origin_product
        FROM events""",
    "list_prices": """
        SELECT cloud, sku_name, price_start_time, price_end_time, p AS default_price, p * 2 AS effective_price
        FROM (SELECT DISTINCT 'CLOUD' AS cloud,
                upper(event_type) || CASE WHEN event_type = 'view' THEN '_SQL' ELSE '_JOBS' END AS sku_name FROM events),
             (VALUES (TIMESTAMP '2023-06-01', TIMESTAMP '2024-01-10', 2.0::DOUBLE),
                     (TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-20', 3.0::DOUBLE),
                     (TIMESTAMP '2024-01-20', NULL, 5.0::DOUBLE)) v(price_start_time, price_end_time, p)""",
    "ops": """
        SELECT upper(event_type) AS operation_type, CAST(floor(value) * 1000000 AS BIGINT) AS optimized_files_size_bytes,
          ts AS operation_timestamp
        FROM events""",
}

SQL["bronze_customers"] = f"""
    WITH c AS ({SQL['customers']}),
    one AS (SELECT '  ' || customer_id || ' ' AS customer_id, ' ' || upper(email) AS email,
              '  ' || name || ' ' AS name, city, state, country, CAST(signup_date AS VARCHAR) AS signup_date,
              'landing' AS source_file FROM c)
    SELECT *, TIMESTAMP '2024-01-01' AS bronze_loaded_ts_utc FROM one
    UNION ALL
    SELECT * REPLACE ('Moved' AS city), TIMESTAMP '2024-01-02' FROM one WHERE customer_id LIKE '%7 '"""
SQL["bronze_orders"] = f"""
    WITH o AS ({SQL['ord']}),
    one AS (SELECT '  ' || order_id || ' ' AS order_id, '  ' || customer_id || ' ' AS customer_id,
              CAST(order_date AS VARCHAR) AS order_date, CAST(order_total AS VARCHAR) AS order_total, order_status,
              'landing' AS source_file FROM o)
    SELECT *, TIMESTAMP '2024-01-01' AS bronze_loaded_ts_utc FROM one
    UNION ALL
    SELECT * REPLACE ('1.5' AS order_total), TIMESTAMP '2024-01-02' FROM one WHERE order_id LIKE '%3 '"""
SQL["bronze_products"] = f"""
    WITH p AS ({SQL['products']}),
    one AS (SELECT '  ' || product_id || ' ' AS product_id, '  ' || product_name || ' ' AS product_name,
              '  ' || category || ' ' AS category, subcategory, CAST(price AS VARCHAR) AS price,
              'landing' AS source_file FROM p)
    SELECT *, TIMESTAMP '2024-01-01' AS bronze_loaded_ts_utc FROM one
    UNION ALL
    SELECT * REPLACE ('2.25' AS price), TIMESTAMP '2024-01-02' FROM one WHERE product_id LIKE '%9 '"""
SQL["bronze_items"] = f"""
    WITH i AS ({SQL['items']})
    SELECT '  ' || order_item_id || ' ' AS order_item_id, '  ' || order_id || ' ' AS order_id,
      '  ' || product_id || ' ' AS product_id, CAST(quantity AS VARCHAR) AS quantity,
      CAST(unit_price AS VARCHAR) AS unit_price, 'landing' AS source_file, bronze_loaded_ts_utc
    FROM i"""

SQL["daily"] = f"""
    WITH o AS ({SQL['ord']}), i AS ({SQL['items']}),
    d AS (SELECT order_date AS date, sum(total_amount) AS total_revenue, count(order_id) AS total_orders,
            count(DISTINCT customer_id) AS unique_customers, sum(total_amount) / count(*) AS average_order_value,
            count(*) FILTER (repeat_customer = 1) AS repeat_orders,
            count(*) FILTER (repeat_customer = 0) AS new_customer_orders
          FROM o GROUP BY 1),
    t AS (SELECT order_date AS date, CAST(sum(quantity) AS BIGINT) AS total_items_sold,
            count(DISTINCT product_id) AS unique_products_sold
          FROM i JOIN o USING (order_id) GROUP BY 1)
    SELECT d.*, round(repeat_orders * 100.0::DOUBLE / total_orders, 2) AS repeat_order_rate,
      total_items_sold, unique_products_sold
    FROM d LEFT JOIN t USING (date)"""
SQL["categories"] = f"""
    WITH i AS ({SQL['items']}), p AS ({SQL['products']})
    SELECT category, CAST(sum(quantity) AS BIGINT) AS total_units_sold, sum(line_total) AS total_revenue,
      count(DISTINCT product_id) AS products_sold, count(DISTINCT order_id) AS orders_with_category,
      sum(line_total) / count(*) AS avg_line_total
    FROM i JOIN p USING (product_id) GROUP BY 1"""


def check(names: str, body: str) -> str:
    """Check SQL over the named entities; `body` may continue the WITH list with a comma."""
    head = "WITH " + ", ".join(f"{n} AS ({SQL[n]})" for n in names.split())
    return f"{head} {body}" if not body.lstrip().startswith(",") else head + body
