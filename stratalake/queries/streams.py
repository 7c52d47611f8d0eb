"""Registered queries: streaming jobs, run until everything available is processed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators.keyed import KeyedParquet
from stratalake.plans.medallion import checked_orders
from stratalake.queries import entities as e
from stratalake.queries.checks import ORDERS_SILVER
from stratalake.queries.entities import check, order_status
from stratalake.queries.filters import ALERT_SQL, MESSAGE_SQL, SEVERITY_SQL
from stratalake.queries.registry import query
from stratalake.queries.storage import (
    CUSTOMER_COLUMNS,
    RESCUE_COLUMNS,
    RESCUED_SQL,
    SCD1,
    line_changes,
    rescued_fields,
    untidy_json,
    write_untidy_csv,
)
from stratalake.schemas import DEVICE_PAYLOAD, ORDERS, schema_for
from stratalake.session import scratch_path
from stratalake.sources import bus, files
from stratalake.streaming import devices, jobs


#: Micro-batches of a scattered table, and the rows of one of its files.
SCATTERED, SCATTERED_ROWS = 4, 1_000_000


def table_stream(spark, sf, table: str) -> DataFrame:
    """A stream over a test table, whether it is one file or a folder of files."""
    schema = e.load(spark, sf, table).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{table}.parquet*")


def scattered_stream(spark, sf, table: str, by: str) -> DataFrame:
    """A stream over the whole table in four micro-batches of unordered rows.

    A row's file follows from `by`; a table of more rows than four files hold has more files in each
    micro-batch, dealt by the whole row."""
    path, rows = scratch_path(spark, "scattered"), e.load(spark, sf, table)
    files_each = max(1, -(-rows.count() // (SCATTERED * SCATTERED_ROWS)))
    part = F.pmod(F.xxhash64(by), F.lit(SCATTERED)) * files_each + F.pmod(F.xxhash64(*rows.columns), F.lit(files_each))
    rows.repartitionById(SCATTERED * files_each, part.cast("int")).write.parquet(path)
    return files.stream_parquet(spark, path, files_per_batch=files_each)


def run(stream: DataFrame, name: str) -> DataFrame:
    base = scratch_path(stream.sparkSession, name)
    return jobs.drain(stream, f"{base}/out", f"{base}/checkpoint")


# -- file and bus sources --------------------------------------------------


def _payload(spark, sf) -> DataFrame:
    """Events as device payloads, with the event number for grouping."""
    i = F.col("event_id")
    return e.load(spark, sf, "events").select(
        i,
        F.col("user_id").cast("string").alias("deviceId"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("ts"),
        F.floor("value").cast("double").alias("temperature"),
        (i % 90).cast("double").alias("humidity"),
        (i % 50 + 980).cast("double").alias("pressure"),
        (i % 100).cast("double").alias("battery"),
        (i % 60).cast("double").alias("lat"),
        (i % 120).cast("double").alias("lon"),
        F.col("event_type").alias("status"),
    )


PAYLOAD_SQL = """SELECT CAST(user_id AS VARCHAR) AS "deviceId", date_trunc('millisecond', ts) AS local_ts,
    CAST(floor(value) AS DOUBLE) AS temperature, CAST(event_id % 90 AS DOUBLE) AS humidity,
    CAST(event_id % 50 + 980 AS DOUBLE) AS pressure, CAST(event_id % 100 AS DOUBLE) AS battery,
    CAST(event_id % 60 AS DOUBLE) AS lat, CAST(event_id % 120 AS DOUBLE) AS lon, event_type AS status FROM events"""


def _document_folder(spark, sf) -> str:
    path = scratch_path(spark, "device-files")
    payload = _payload(spark, sf)
    record = F.struct(*[c for c in payload.columns if c != "event_id"])
    (
        payload.groupBy(F.floor(F.col("event_id") / 5000))
        .agg(F.to_json(F.collect_list(record)).alias("value"))
        .select("value")
        .write.option("maxRecordsPerFile", 1)
        .text(path)
    )
    return path


@query("src_stream_files_json", PAYLOAD_SQL.replace("date_trunc('millisecond', ts) AS local_ts", "strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS ts"))
def src_stream_files_json(spark, sf):
    return run(files.stream_json(spark, _document_folder(spark, sf), DEVICE_PAYLOAD), "json-stream")


@query("stm_normalize", PAYLOAD_SQL.replace(" FROM events", ", NULL AS _rescued_data FROM events"))
def stm_normalize(spark, sf):
    raw = files.stream_json_rescued(spark, _document_folder(spark, sf), DEVICE_PAYLOAD)
    return run(devices.normalise(raw), "normalised").drop("server_ts_utc")


@query("src_rescued_stream", RESCUED_SQL)
def src_rescued_stream(spark, sf):
    path = scratch_path(spark, "untidy")
    untidy_json(spark, sf).write.text(path)
    stream = files.stream_json_rescued(spark, path, RESCUE_COLUMNS, array_files=False)
    return rescued_fields(run(stream, "rescued"))


@query(
    "src_stream_files_csv",
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS order_total, o_orderpriority AS priority FROM orders",
)
def src_stream_files_csv(spark, sf):
    base = scratch_path(spark, "csv-stream")
    orders = e.load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("order_total"),
        F.col("o_orderpriority").alias("priority"),
    )
    write_untidy_csv(orders, "order_id", f"{base}/in")
    where = (f"{base}/in/*", f"{base}/out", f"{base}/checkpoint")
    return jobs.load_csv(spark, *where, store=f"{base}/schema", files_per_batch=2).drop("note")


@query(
    "src_stream_files_csv_fixed",
    check(
        "ord",
        """SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, order_date,
             payment_method, CAST(1 AS INTEGER) AS days_since_last_purchase, repeat_customer,
             order_total AS total_amount, NULL AS _rescued_data, TRUE AS has_file, TRUE AS has_time FROM ord""",
    ),
)
def src_stream_files_csv_fixed(spark, sf):
    base = scratch_path(spark, "bronze")
    known = e.orders(spark, sf).withColumn("days_since_last_purchase", F.lit(1)).drop("total_amount")
    text = known.withColumnRenamed("order_total", "total_amount")
    write_untidy_csv(text.select(*ORDERS.fieldNames()), "order_id", f"{base}/orders")
    where = (f"{base}/orders/*", f"{base}/out", f"{base}/checkpoint")
    loaded = jobs.load_csv(spark, *where, schema=schema_for("orders"), rescue=True, audit=True)
    other = F.when(F.col("_rescued_data") != '{"note":"n, b"}', F.col("_rescued_data"))
    return loaded.select(
        *ORDERS.fieldNames(),
        other.alias("_rescued_data"),
        F.col("source_file").isNotNull().alias("has_file"),
        F.col("bronze_loaded_ts_utc").isNotNull().alias("has_time"),
    )


def _messages(spark, sf, path: str) -> None:
    """Bus messages of at most fifty payloads each."""
    payload = _payload(spark, sf)
    record = F.struct(*[c for c in payload.columns if c != "event_id"])
    (
        payload.groupBy(F.floor(F.col("event_id") / 50).alias("g"))
        .agg(F.to_json(F.collect_list(record)).cast("binary").alias("body"))
        .select("body", F.lit("2024-02-01").cast("timestamp").alias("enqueuedTime"), (F.col("g") % 4).cast("string").alias("partition"))
        .write.parquet(path)
    )


@query("src_stream_bus", PAYLOAD_SQL.replace("date_trunc('millisecond', ts) AS local_ts", "strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS local_ts"))
def src_stream_bus(spark, sf):
    path = scratch_path(spark, "bus")
    _messages(spark, sf, path)
    readings = devices.full_readings(bus.captured_stream(spark, path))
    return run(readings, "bus-out").drop("eh_enqueued_ts", "partition", "server_ts_utc")


@query(
    "stm_parse_array",
    check(
        "readings",
        """SELECT "deviceId", date_trunc('millisecond', event_timestamp) AS event_timestamp, temperature, battery
           FROM readings""",
    ),
)
def stm_parse_array(spark, sf):
    path = scratch_path(spark, "bus")
    _messages(spark, sf, path)
    parsed = devices.alert_readings(bus.captured_stream(spark, path))
    return run(parsed, "parsed").drop("eh_enqueued_ts", "partition")


@query("src_stream_table", "SELECT * FROM supplier")
def src_stream_table(spark, sf):
    return run(table_stream(spark, sf, "supplier"), "suppliers")


@query("snk_stream_append", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem")
def snk_stream_append(spark, sf):
    return run(table_stream(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), "lines")


@query("stm_output_append", "SELECT event_id, event_type, value FROM events WHERE value > 50")
def stm_output_append(spark, sf):
    return run(table_stream(spark, sf, "events").where("value > 50").select("event_id", "event_type", "value"), "appended")


@query("snk_copy_into", "SELECT * FROM customer")
def snk_copy_into(spark, sf):
    """Two feeds into one target, each loaded twice with its checkpoint: each file counts once.
    Headers differ between files."""
    base = scratch_path(spark, "copy")
    customers = e.load(spark, sf, "customer")
    for feed, part in (("a", F.col("c_acctbal") < 4000), ("b", F.coalesce(F.col("c_acctbal") >= 4000, F.lit(True)))):
        write_untidy_csv(customers.where(part), "c_custkey", f"{base}/in-{feed}")
        for _ in range(2):
            loaded = jobs.load_csv(spark, f"{base}/in-{feed}/*", f"{base}/out", f"{base}/checkpoint-{feed}", schema=CUSTOMER_COLUMNS)
    return loaded


# -- windows and alerts ----------------------------------------------------

SUMMARY = """SELECT "deviceId", time_bucket(INTERVAL 5 MINUTE, event_timestamp, TIMESTAMP '1970-01-01') AS window_start,
      time_bucket(INTERVAL 5 MINUTE, event_timestamp, TIMESTAMP '1970-01-01') + INTERVAL 5 MINUTE AS window_end,
      count(*) AS message_count, sum(temperature) / count(*) AS avg_temperature, sum(battery) / count(*) AS avg_battery,
      min(temperature) AS min_temperature, max(temperature) AS max_temperature, min(battery) AS min_battery,
      max(battery) AS max_battery, arg_max(temperature, event_timestamp) AS last_temperature,
      arg_max(battery, event_timestamp) AS last_battery, max(temperature) - min(temperature) AS temperature_range,
      max(battery) - min(battery) AS battery_range
    FROM readings GROUP BY 1, 2, 3"""
CLOSED = f"""SELECT * FROM ({SUMMARY}) WHERE window_end <=
    (SELECT date_trunc('millisecond', max(event_timestamp)) - INTERVAL 5 MINUTE FROM readings)"""


def _reading_stream(spark, sf):
    return devices.with_lateness(e.readings_of(table_stream(spark, sf, "events")))


@query("stm_tumbling", check("readings", CLOSED))
def stm_tumbling(spark, sf):
    return run(devices.device_summary(_reading_stream(spark, sf)), "summary")


@query("stm_tumbling_batch", check("readings", SUMMARY))
def stm_tumbling_batch(spark, sf):
    return devices.device_summary(e.readings(spark, sf))


@query(
    "stm_watermark",
    check(
        "readings",
        """, w AS (SELECT time_bucket(INTERVAL 1 HOUR, event_timestamp, TIMESTAMP '1970-01-01') AS hour, count(*) AS n
             FROM readings GROUP BY 1)
           SELECT * FROM w WHERE hour + INTERVAL 1 HOUR <=
             (SELECT date_trunc('millisecond', max(event_timestamp)) - INTERVAL 1 DAY FROM readings)""",
    ),
)
def stm_watermark(spark, sf):
    stream = e.readings_of(table_stream(spark, sf, "events")).withWatermark("event_timestamp", "1 day")
    counts = stream.groupBy(F.window("event_timestamp", "1 hour")).count()
    return run(counts.select(F.col("window.start").alias("hour"), F.col("count").alias("n")), "hours")


@query("stm_batch_equiv", check("readings", f"SELECT count(*) AS stream_rows, count(*) AS batch_rows, count(*) AS equal_rows FROM ({CLOSED})"))
def stm_batch_equiv(spark, sf):
    """Stream result against the batch result of the closed windows."""
    stream = run(devices.device_summary(_reading_stream(spark, sf)), "summary")
    readings = e.readings(spark, sf)
    mark = readings.agg(F.date_trunc("millisecond", F.max("event_timestamp")) - F.expr("INTERVAL 5 MINUTES")).scalar()
    batch = devices.device_summary(readings).where(F.col("window_end") <= mark)
    keys = ["deviceId", "window_start"]
    same = F.lit(True)
    for c in stream.columns:
        same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"b.{c}"))
    match = [F.col(f"s.{k}") == F.col(f"b.{k}") for k in keys]
    both = stream.alias("s").join(batch.alias("b"), match, "full_outer")
    return both.agg(
        F.count("s.deviceId").alias("stream_rows"),
        F.count("b.deviceId").alias("batch_rows"),
        F.count_if(same).alias("equal_rows"),
    )


ALERTS = f""", r AS (SELECT *, {ALERT_SQL} FROM readings)
    SELECT *, {MESSAGE_SQL}, {SEVERITY_SQL} FROM r WHERE alert_type <> 'NORMAL'"""


@query("stm_alerts", check("readings", ALERTS))
def stm_alerts(spark, sf):
    return run(devices.device_alerts(_reading_stream(spark, sf)), "alerts")


@query(
    "stm_multi_query",
    check(
        "readings",
        f""", r AS (SELECT *, {ALERT_SQL} FROM readings)
        SELECT 'alerts' AS sink, count(*) AS n FROM r WHERE alert_type <> 'NORMAL'
        UNION ALL SELECT 'summary', count(*) FROM ({CLOSED})""",
    ),
)
def stm_multi_query(spark, sf):
    """Two sinks fed by one source, each with its own checkpoint, running side by side."""
    base = scratch_path(spark, "two")
    readings = _reading_stream(spark, sf)
    plans = {"summary": devices.device_summary(readings), "alerts": devices.device_alerts(readings)}
    started = [
        jobs.append_to_path(s, f"{base}/{n}", f"{base}/{n}-checkpoint", n, available_now=True) for n, s in plans.items()
    ]
    for q in started:
        q.awaitTermination()
    counts = None
    for n, s in plans.items():
        rows = spark.read.schema(s.schema).parquet(f"{base}/{n}")
        one = rows.agg(F.lit(n).alias("sink"), F.count(F.lit(1)).alias("n"))
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query("stm_dedup", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def stm_dedup(spark, sf):
    lines = table_stream(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return run(jobs.drop_duplicates_forever(lines, ["l_orderkey", "l_linenumber"]), "unique")


@query("stm_dedup_bounded", "SELECT DISTINCT event_id FROM events")
def stm_dedup_bounded(spark, sf):
    """Every event delivered twice; copies fall within the delay."""
    events = table_stream(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    twice = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return run(jobs.drop_duplicates_within(twice, ["event_id"], "ts", "1 hour"), "unique").select("event_id")


# -- orders ----------------------------------------------------------------


def _order_stream(spark, sf, stream=None):
    return (table_stream(spark, sf, "orders") if stream is None else stream).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("timestamp").alias("order_date"),
        F.col("o_totalprice").alias("order_total"),
        order_status().alias("order_status"),
    )


@query("pipe_orders_silver_stream", check("ord", ORDERS_SILVER))
def pipe_orders_silver_stream(spark, sf):
    """The order table in several batches, dates mixed: every first copy is kept."""
    batches = scattered_stream(spark, sf, "orders", "o_orderkey")
    return run(jobs.orders_stream(_order_stream(spark, sf, batches)), "orders-silver")


GEO_STREAM = check(
    "ord customers",
    """, g AS (SELECT time_bucket(INTERVAL 30 DAY, CAST(order_date AS TIMESTAMP), TIMESTAMP '1970-01-01') AS period_start,
         time_bucket(INTERVAL 30 DAY, CAST(order_date AS TIMESTAMP), TIMESTAMP '1970-01-01') + INTERVAL 30 DAY
           AS period_end, country, state, count(order_id) AS total_orders, sum(total_amount) AS total_revenue,
         sum(total_amount) / count(*) AS avg_order_value, max(total_amount) AS max_order_value,
         sum(CASE WHEN trim(lower(order_status)) = 'delivered' THEN total_amount ELSE 0 END) AS delivered_revenue,
         count(DISTINCT customer_id) AS unique_customers, sum(total_amount) / count(DISTINCT customer_id) AS revenue_per_customer
       FROM ord JOIN customers USING (customer_id) WHERE trim(order_status) <> 'cancelled' GROUP BY 1, 2, 3, 4)
       SELECT * FROM g WHERE period_end <= (SELECT max(CAST(order_date AS TIMESTAMP)) - INTERVAL 1 DAY
         FROM ord WHERE trim(order_status) <> 'cancelled')""",
)


def _geo(spark, sf):
    silver = checked_orders(_order_stream(spark, sf)).withColumn("order_total", F.round(F.col("order_total") * 100))
    return run(jobs.geographic_stream(silver, e.customers(spark, sf)), "geo")


@query("stm_window_30d", GEO_STREAM)
def stm_window_30d(spark, sf):
    """All closed 30-day windows."""
    return _geo(spark, sf)


@query(
    "join_stream_static",
    check(
        "ord customers",
        """SELECT order_id, customer_id, country, state FROM ord JOIN customers USING (customer_id)""",
    ),
)
def join_stream_static(spark, sf):
    customers = e.customers(spark, sf).select("customer_id", "country", "state").hint("merge")  # no broadcast per micro-batch
    joined = _order_stream(spark, sf).join(customers, "customer_id")
    return run(joined.select("order_id", "customer_id", "country", "state"), "located")


# -- change feed -----------------------------------------------------------


@query("cdc_scd1_stream", SCD1)
def cdc_scd1_stream(spark, sf):
    """The change feed of `cdc_scd1` applied by micro-batches into a stored table."""
    base = scratch_path(spark, "cdc")
    target = KeyedParquet(spark, f"{base}/lines", ["l_orderkey", "l_linenumber"])
    feed = line_changes(scattered_stream(spark, sf, "lineitem", "l_partkey"))
    rules = {"has_order": "l_orderkey IS NOT NULL", "has_line": "l_linenumber IS NOT NULL"}
    jobs.change_stream(feed, target, "seq", f"{base}/checkpoint", rules).awaitTermination()
    return jobs.current_rows(target, ["seq"])
