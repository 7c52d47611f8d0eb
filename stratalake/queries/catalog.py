"""Registered queries that go through catalog tables in a scratch schema."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stratalake.operators import sinks
from stratalake.plans import loads
from stratalake.queries import entities as e
from stratalake.queries.entities import check
from stratalake.queries.registry import query
from stratalake.session import scratch_path
from stratalake.sources import rest
from stratalake.streaming import jobs


def scratch_schema(spark: SparkSession) -> str:
    """A fresh schema whose tables lie in the shared folder."""
    name = f"strata_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{scratch_path(spark, name)}'")
    return name


@query(
    "snk_append_evolve",
    """SELECT o_orderkey, o_totalprice, NULL AS o_orderpriority, o_orderstatus FROM orders
       WHERE o_orderdate < TIMESTAMP '1998-01-01'
       UNION ALL SELECT o_orderkey, o_totalprice, o_orderpriority, o_orderstatus FROM orders
       WHERE o_orderdate >= TIMESTAMP '1998-01-01'""",
)
def snk_append_evolve(spark, sf):
    """An append that brings a new column."""
    orders = e.load(spark, sf, "orders")
    table = f"spark_catalog.{scratch_schema(spark)}.orders"
    turn = F.lit("1998-01-01").cast("timestamp_ntz")
    early = orders.where(F.col("o_orderdate") < turn).select("o_orderkey", "o_totalprice", "o_orderstatus")
    later = orders.where(F.col("o_orderdate") >= turn)
    sinks.write_table(early, table, ["o_orderstatus"])
    sinks.write_table(later.select("o_orderpriority", "o_orderkey", "o_totalprice", "o_orderstatus"), table, ["o_orderstatus"])
    return spark.table(table)


@query("snk_external_table", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def snk_external_table(spark, sf):
    path = scratch_path(spark, "external")
    orders = e.load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    sinks.write_partitioned(orders, path, "o_orderstatus")
    table = f"{scratch_schema(spark)}.orders"
    sinks.register_external(spark, table, path)
    return spark.table(table)


@query("snk_schema_ddl", "SELECT c_custkey AS customer_id, c_name AS name, c_acctbal AS balance FROM customer")
def snk_schema_ddl(spark, sf):
    """A declared table with column comments, then filled."""
    table = f"{scratch_schema(spark)}.customers"
    columns = {
        "customer_id": ("BIGINT", "Unique customer identifier"),
        "name": ("STRING", "Full name of the customer"),
        "balance": ("DOUBLE", "Account balance"),
    }
    sinks.create_table(spark, table, columns, "Customers")
    e.load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal").write.insertInto(table)
    return spark.table(table)


@query("snk_ctas", "SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1")
def snk_ctas(spark, sf):
    """Created from a query, then replaced by another one."""
    table = f"{scratch_schema(spark)}.order_counts"
    orders = e.load(spark, sf, "orders")
    sinks.create_or_replace_as(spark, table, orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("largest")))
    sinks.create_or_replace_as(spark, table, orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders")))
    return spark.table(table)


@query(
    "snk_view",
    """SELECT event_id AS post_id, event_type AS title, c_name AS author_name, c_mktsegment AS company_name, n_name AS city
       FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def snk_view(spark, sf):
    """Posts and users as tables, joined by a stored view."""
    schema = scratch_schema(spark)
    posts = e.load(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("userId"), F.col("event_type").alias("title"), F.col("props").alias("body")
    )
    users = e.customers(spark, sf).select(
        F.col("customer_id").alias("user_id"), "name", F.col("segment").alias("company_name"), "city"
    )
    sinks.overwrite_table(sinks.add_ingestion_time(rest.flatten_posts(posts)), f"{schema}.posts")
    sinks.overwrite_table(sinks.add_ingestion_time(users), f"{schema}.users")
    rest.create_authors_view(spark, f"{schema}.posts_with_authors", f"{schema}.posts", f"{schema}.users")
    return spark.table(f"{schema}.posts_with_authors")


@query("snk_noop", "SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders FROM lineitem")
def snk_noop(spark, sf):
    """The plan runs once into the discarding sink and is then returned."""
    counts = e.load(spark, sf, "lineitem").agg(
        F.count("*").alias("n_rows"), F.countDistinct("l_orderkey").alias("n_orders")
    )
    sinks.discard(counts)
    return counts


@query(
    "inc_full_load",
    check(
        "ord customers",
        """SELECT order_id, order_date, name AS customer_name, total_amount, order_status
           FROM ord JOIN customers USING (customer_id)""",
    ),
)
def inc_full_load(spark, sf):
    """Both tables reloaded with a stamp, then verified by their join."""
    schema = scratch_schema(spark)
    customers = e.customers(spark, sf).select("customer_id", F.col("name").alias("customer_name"))
    loads.full_load(customers, f"{schema}.customers")
    loads.full_load(e.orders(spark, sf), f"{schema}.orders")
    return loads.verify_orders(spark.table(f"{schema}.orders"), spark.table(f"{schema}.customers"))


# -- streams that need steps -----------------------------------------------


@query("snk_stream_status", "SELECT 'watched' AS name, TRUE AS has_id, TRUE AS has_status, (SELECT count(*) FROM supplier) AS n_rows")
def snk_stream_status(spark, sf):
    """The status list while a query runs, with the rows that query wrote."""
    base = scratch_path(spark, "status")
    schema = e.load(spark, sf, "supplier").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf}/supplier.parquet*")
    running = jobs.append_to_path(stream, f"{base}/out", f"{base}/checkpoint", "watched")
    try:
        running.processAllAvailable()
        seen = [q for q in jobs.active_queries(spark) if q["id"] == str(running.id)]
    finally:
        running.stop()
    status = spark.createDataFrame([(q["name"], bool(q["id"]), bool(q["status"])) for q in seen], "name STRING, has_id BOOLEAN, has_status BOOLEAN")
    rows = spark.read.schema(schema).parquet(f"{base}/out").agg(F.count(F.lit(1)).alias("n_rows"))
    return status.withColumn("n_rows", rows.scalar())


LATE_SQL = """WITH a AS (SELECT ts, event_type = 'signup' AS held, ts < TIMESTAMP '2024-01-20' AS early FROM events),
    mark AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY AS first_mark FROM a WHERE early AND NOT held),
    w AS (SELECT *, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS period_start FROM a),
    kept AS (SELECT * FROM w, mark WHERE (early AND NOT held) OR period_start + INTERVAL 6 HOUR > first_mark)
    SELECT period_start, count(*) AS n FROM kept GROUP BY 1
    HAVING period_start + INTERVAL 6 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY FROM a)"""


@query("stm_late_data", LATE_SQL)
def stm_late_data(spark, sf):
    """The early sign-ups arrive in a second delivery: those within a day of the
    newest event are counted, the others are dropped."""
    base = scratch_path(spark, "late")
    events = e.load(spark, sf, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    early, held = F.col("ts") < F.lit("2024-01-20").cast("timestamp"), F.col("event_type") == "signup"
    deliveries = [events.where(early & ~held), events.where(~(early & ~held))]
    for rows in deliveries:
        rows.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{base}/in").withWatermark("ts", "1 day")
        counts = stream.groupBy(F.window("ts", "6 hours")).count()
        out = jobs.drain(
            counts.select(F.col("window.start").alias("period_start"), F.col("count").alias("n")),
            f"{base}/out",
            f"{base}/checkpoint",
        )
    return out


@query(
    "stm_static_refresh",
    check(
        "ord customers",
        """SELECT order_id, customer_id, country FROM ord JOIN customers USING (customer_id)
           WHERE segment IN ('BUILDING', 'MACHINERY') OR order_date >= DATE '1998-01-01'""",
    ),
)
def stm_static_refresh(spark, sf):
    """One running query: the customer table gains rows between two micro-batches, and the
    second batch sees them."""
    base, table = scratch_path(spark, "refresh"), f"{scratch_schema(spark)}.customers"
    known = F.col("segment").isin("BUILDING", "MACHINERY")
    customers, columns = e.customers(spark, sf), ["customer_id", "country"]
    orders = e.orders(spark, sf).select("order_id", "customer_id", "order_date")
    customers.where(known).select(*columns).write.saveAsTable(table)
    orders.where("order_date < '1998-01-01'").write.parquet(f"{base}/in")
    stream = spark.readStream.schema(orders.schema).parquet(f"{base}/in")
    located = stream.join(spark.table(table), "customer_id").select("order_id", "customer_id", "country")
    running = jobs.append_to_path(located, f"{base}/out", f"{base}/checkpoint")
    try:
        running.processAllAvailable()
        customers.where(~known).select(*columns).write.insertInto(table)
        orders.where("order_date >= '1998-01-01'").write.mode("append").parquet(f"{base}/in")
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.schema(located.schema).parquet(f"{base}/out")
