"""Registered queries: sources, sinks, upserts, loads, layout, caching.

Each writes a whole test table to the shared scratch folder in the form the operator
reads, and returns what the operator made of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators import layout, merge, sinks
from stratalake.operators.caching import LEVELS, kept
from stratalake.operators.clustered import ClusteredParquet
from stratalake.operators.keyed import KeyedParquet
from stratalake.plans import loads
from stratalake.queries import entities as e
from stratalake.queries.entities import check
from stratalake.queries.registry import query
from stratalake.schemas import columns
from stratalake.session import scratch_path, shuffle_width
from stratalake.sources import files, synthetic

# -- sources ---------------------------------------------------------------

CUSTOMER_COLUMNS = columns("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING")
PART_COLUMNS = columns("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE")


def write_untidy_csv(df: DataFrame, key: str, path: str) -> None:
    """Three folders of CSV files: columns in order, in reverse, and with one more in front."""
    part = F.pmod(F.xxhash64(key), F.lit(3))
    forms = (df.columns, df.columns[::-1], ["note", *df.columns])
    for i, names in enumerate(forms):
        rows = df.withColumn("note", F.lit("n, b")).where(part == i).select(*names)
        rows.write.option("header", "true").csv(f"{path}/form={i}")


@query("src_csv_schema", "SELECT * FROM customer")
def src_csv_schema(spark, sf):
    """Files with their columns in different orders, some with a column that is not known."""
    path = scratch_path(spark, "csv")
    write_untidy_csv(e.load(spark, sf, "customer"), "c_custkey", path)
    return files.csv_with_schema(spark, f"{path}/*", CUSTOMER_COLUMNS)


@query(
    "src_csv_rescued",
    """SELECT p_partkey, p_name, p_brand, p_type, CASE WHEN p_partkey % 50 <> 0 THEN p_size END AS p_size, p_retailprice,
         p_partkey % 50 = 0 AS has_size_rescued FROM part""",
)
def src_csv_rescued(spark, sf):
    """The same with sizes that are no numbers; what does not fit is kept by name."""
    path, part = scratch_path(spark, "csv"), e.load(spark, sf, "part").select(*PART_COLUMNS.fieldNames())
    size = F.when(F.col("p_partkey") % 50 == 0, "large").otherwise(F.col("p_size").cast("string"))
    write_untidy_csv(part.withColumn("p_size", size), "p_partkey", path)
    found = files.csv_rescued(spark, f"{path}/*", PART_COLUMNS)
    held = F.coalesce(F.get_json_object("_rescued_data", "$.p_size") == "large", F.lit(False))
    return found.withColumn("has_size_rescued", held).drop("_rescued_data")


@query(
    "src_csv_glob_cast",
    check(
        "ord",
        """SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, order_date,
             CASE WHEN order_id % 20 <> 0 THEN order_total END AS order_total, order_status, TRUE AS has_file,
             TRUE AS has_time
           FROM (SELECT * REPLACE (trim(order_status) AS order_status) FROM ord)""",
    ),
)
def src_csv_glob_cast(spark, sf):
    """Orders as text two folder levels down, with columns in any order and some totals that
    are no numbers."""
    base = scratch_path(spark, "staging")
    total = F.when(F.col("order_id") % 20 == 0, "n/a").otherwise(F.col("order_total").cast("string"))
    text = e.orders(spark, sf).select(
        "order_id", "customer_id", "order_date", total.alias("order_total"), F.trim("order_status").alias("order_status"),
    )
    write_untidy_csv(text, "order_id", f"{base}/orders/all")
    loaded = files.load_bronze(spark, "orders", base)
    return loaded.select(
        "order_id", "customer_id", "order_date", "order_total", "order_status",
        F.col("source_file").endswith(".csv").alias("has_file"),
        F.col("bronze_loaded_ts_utc").isNotNull().alias("has_time"),
    )


def _documents(df: DataFrame, key: str, per_file: int = 5000, pretty: bool = True) -> DataFrame:
    """JSON array documents of at most `per_file` neighbouring records each."""
    record = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(F.floor(F.col(key) / per_file)).agg(
        F.to_json(F.collect_list(record), {"pretty": str(pretty).lower()}).alias("value")
    ).select("value")


def write_documents(df: DataFrame, key: str, path: str, per_file: int = 5000) -> None:
    _documents(df, key, per_file).write.option("maxRecordsPerFile", 1).text(path)


@query("src_json_multiline", "SELECT * FROM part")
def src_json_multiline(spark, sf):
    path = scratch_path(spark, "json")
    write_documents(e.load(spark, sf, "part"), "p_partkey", path)
    return files.json_documents(spark, path, PART_COLUMNS)


def _orders_by_month(spark, sf, path):
    orders = e.orders(spark, sf).withColumn("year", F.year("order_date")).withColumn("month", F.month("order_date"))
    sinks.write_partitioned(orders, path, "year", "month")


@query(
    "src_parquet_pruned",
    check("ord", "SELECT order_id, total_amount, 1997 AS year, 6 AS month FROM ord WHERE year(order_date) = 1997 AND month(order_date) = 6"),
)
def src_parquet_pruned(spark, sf):
    path = scratch_path(spark, "months")
    _orders_by_month(spark, sf, path)
    return files.partitioned(spark, path, year=1997, month=6).select("order_id", "total_amount", "year", "month")


@query("snk_partitioned", check("ord", "SELECT order_id, total_amount, year(order_date) AS year, month(order_date) AS month FROM ord"))
def snk_partitioned(spark, sf):
    path = scratch_path(spark, "months")
    _orders_by_month(spark, sf, path)
    return spark.read.parquet(path).select("order_id", "total_amount", "year", "month")


@query(
    "src_dated_partition",
    check(
        "raw_sales",
        "SELECT event_id, customer_id, quantity, unit_price, event_timestamp FROM raw_sales WHERE CAST(event_timestamp AS DATE) = DATE '2024-01-15'",
    ),
)
def src_dated_partition(spark, sf):
    path = scratch_path(spark, "dated")
    dated = e.raw_sales(spark, sf).withColumn("date", F.to_date("event_timestamp"))
    sinks.write_partitioned(dated, path, "date")
    day = files.dated_partition(spark, path, "2024-01-15")
    return day.select("event_id", "customer_id", "quantity", "unit_price", "event_timestamp")


@query("src_table", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def src_table(spark, sf):
    e.load(spark, sf, "supplier").createOrReplaceTempView("strata_supplier")
    return spark.table("strata_supplier").select("s_suppkey", "s_name", "s_acctbal")


@query(
    "src_inline",
    """SELECT c_custkey, code FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
       JOIN (VALUES ('AFRICA', 'AF'), ('ASIA', 'AS'), ('EUROPE', 'EU'), ('AMERICA', 'AM'), ('MIDDLE EAST', 'ME')) v(r_name, code)
         USING (r_name)""",
)
def src_inline(spark, sf):
    rows = [("AFRICA", "AF"), ("ASIA", "AS"), ("EUROPE", "EU"), ("AMERICA", "AM"), ("MIDDLE EAST", "ME")]
    codes = spark.createDataFrame(rows, "country STRING, code STRING")
    return e.customers(spark, sf).join(codes, "country").select(F.col("customer_id").alias("c_custkey"), "code")


def _ids(spark, sf):
    return e.load(spark, sf, "events").select(F.col("event_id").alias("id"))


def _facts(df, **facts):
    """Row count and whether each fact holds for all rows."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.bool_and(F.coalesce(c, F.lit(False))).alias(n) for n, c in facts.items()])


def _number(c: str):
    return F.regexp_extract(c, "-([0-9]+)$", 1).cast("long")


@query(
    "src_synthetic_sales",
    """SELECT count(*) AS n_rows, TRUE AS known_event, TRUE AS known_customer, TRUE AS known_product, TRUE AS known_region,
         TRUE AS good_quantity, TRUE AS good_price, TRUE AS good_revenue, TRUE AS good_date FROM events""",
)
def src_synthetic_sales(spark, sf):
    """A generated sale per event, and what holds for all of them."""
    made, ids = synthetic.sales(_ids(spark, sf)), _ids(spark, sf).select(F.col("id").alias("known"))
    named = made.join(ids, _number("event_id") == F.col("known"), "left")
    return _facts(
        named,
        known_event=F.col("known").isNotNull(),
        known_customer=_number("customer_id").between(0, 99_999),
        known_product=_number("product_id").between(0, 9_999),
        known_region=F.col("region").isin(synthetic.REGIONS),
        good_quantity=F.col("quantity").between(1, 10),
        good_price=F.col("unit_price").between(1, 501),
        good_revenue=F.abs(F.col("revenue_usd") - F.col("quantity") * F.col("unit_price")) < 0.006,
        good_date=F.year("event_date").between(2022, 2023) & (F.to_date("event_timestamp") == F.col("event_date")),
    )


@query(
    "src_synthetic_events",
    "SELECT count(*) AS n_rows, TRUE AS good_user, TRUE AS known_type, TRUE AS good_value, TRUE AS good_parts FROM events",
)
def src_synthetic_events(spark, sf):
    day = F.col("timestamp")
    return _facts(
        synthetic.events(_ids(spark, sf)),
        good_user=F.col("user_id").between(1, 1000),
        known_type=F.col("event_type").isin(synthetic.EVENT_TYPES),
        good_value=F.col("value").between(10, 500),
        good_parts=(F.col("year") == 2023) & (F.month(day) == F.col("month")) & (F.year(day) == F.col("year")),
    )


@query("src_skewed", "SELECT count(*) AS n_rows, TRUE AS good_key, TRUE AS good_amount, TRUE AS hot_share FROM events")
def src_skewed(spark, sf):
    """One key holds nine rows in ten."""
    rows = synthetic.skewed(_ids(spark, sf))
    facts = _facts(rows, good_key=F.col("customer_id").between(1, 100), good_amount=F.col("amount").between(10, 1000))
    hot = rows.agg(F.avg(F.when(F.col("customer_id") == 1, 1).otherwise(0)).between(0.85, 0.95).alias("hot_share"))
    return facts.withColumn("hot_share", hot.scalar())


@query("src_file_metadata", "SELECT o_orderkey, TRUE AS from_orders FROM orders")
def src_file_metadata(spark, sf):
    audited = sinks.add_bronze_audit_cols(e.load(spark, sf, "orders"))
    return audited.select("o_orderkey", F.col("source_file").contains("orders.parquet").alias("from_orders"))


@query(
    "prj_audit",
    "SELECT o_orderkey, TRUE AS has_file, TRUE AS has_bronze_time, TRUE AS has_silver_time FROM orders",
)
def prj_audit(spark, sf):
    audited = sinks.add_silver_audit_cols(sinks.add_bronze_audit_cols(e.load(spark, sf, "orders")))
    return audited.select(
        "o_orderkey",
        F.col("source_file").isNotNull().alias("has_file"),
        F.col("bronze_loaded_ts_utc").isNotNull().alias("has_bronze_time"),
        F.col("silver_loaded_ts_utc").isNotNull().alias("has_silver_time"),
    )


RESCUE_COLUMNS = columns("id BIGINT, kind STRING, value DOUBLE")
RESCUED_SQL = """SELECT event_id AS id, event_type AS kind, CASE WHEN event_id % 7 <> 0 THEN value END AS value,
    CASE WHEN event_id % 7 = 0 AND event_id % 5 = 0 THEN 'value,extra' WHEN event_id % 7 = 0 THEN 'value'
         WHEN event_id % 5 = 0 THEN 'extra' END AS rescued_fields FROM events"""


def untidy_json(spark, sf) -> DataFrame:
    """Events as JSON lines: some values are no numbers, some records have an unknown field."""
    i = F.col("event_id")
    value = F.when(i % 7 == 0, "n/a").otherwise(F.col("value").cast("string"))
    record = F.struct(
        i.alias("id"), F.col("event_type").alias("kind"), value.alias("value"), F.when(i % 5 == 0, "x").alias("extra")
    )
    return e.load(spark, sf, "events").select(F.to_json(record).alias("value"))


def rescued_fields(df: DataFrame) -> DataFrame:
    names = F.map_keys(F.from_json("_rescued_data", "MAP<STRING, STRING>"))
    joined = F.when(F.size(names) > 0, F.array_join(F.reverse(F.array_sort(names)), ","))
    return df.withColumn("rescued_fields", joined).drop("_rescued_data")


@query("src_rescued", RESCUED_SQL)
def src_rescued(spark, sf):
    path = scratch_path(spark, "untidy")
    untidy_json(spark, sf).write.text(path)
    return rescued_fields(files.json_rescued(spark, path, RESCUE_COLUMNS))


@query(
    "src_schema_drift",
    """SELECT o_orderkey, o_totalprice, NULL AS o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
       UNION ALL SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""",
)
def src_schema_drift(spark, sf):
    """Early files lack a column that later files have."""
    path, orders = scratch_path(spark, "drift"), e.load(spark, sf, "orders")
    turn = F.lit("1998-01-01").cast("timestamp_ntz")
    orders.where(F.col("o_orderdate") < turn).select("o_orderkey", "o_totalprice").write.parquet(f"{path}/batch=1")
    orders.where(F.col("o_orderdate") >= turn).select("o_orderkey", "o_totalprice", "o_orderpriority").write.parquet(
        f"{path}/batch=2"
    )
    return files.parquet_merged(spark, path).drop("batch")


# -- sinks -----------------------------------------------------------------


@query("snk_overwrite", "SELECT s_suppkey AS supplier_id, upper(s_name) AS supplier_name FROM supplier")
def snk_overwrite(spark, sf):
    """A second write replaces rows and schema."""
    path = scratch_path(spark, "supplier")
    first = e.load(spark, sf, "supplier").withColumnRenamed("s_suppkey", "supplier_id")
    first.write.mode("overwrite").parquet(path)
    first.select("supplier_id", F.upper("s_name").alias("supplier_name")).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("snk_tempview", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def snk_tempview(spark, sf):
    e.load(spark, sf, "orders").createOrReplaceTempView("strata_orders")
    return spark.sql("SELECT o_orderpriority, count(*) AS n FROM strata_orders GROUP BY o_orderpriority")


@query(
    "act_collect",
    "SELECT (SELECT count(*) FROM orders) AS n_rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders",
)
def act_collect(spark, sf):
    orders = e.load(spark, sf, "orders").select("o_orderkey")
    first = orders.orderBy("o_orderkey").first()[0]
    last = orders.orderBy(F.desc("o_orderkey")).take(1)[0][0]
    return orders.agg(F.count("*").alias("n_rows"), F.lit(first).alias("first_key"), F.lit(last).alias("last_key"))


# -- upserts ---------------------------------------------------------------

CHANGED_SQL = "o_orderstatus = 'P' OR o_orderpriority = '1-URGENT'"
MERGED = f"""SELECT o_orderkey, CASE WHEN {CHANGED_SQL} THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
    CASE WHEN {CHANGED_SQL} THEN 'new' ELSE 'old' END AS version FROM orders"""


def _merge_sides(spark, sf):
    """The target lacks the pending orders; the source holds these and the urgent ones."""
    orders = e.load(spark, sf, "orders")
    target = orders.where("o_orderstatus <> 'P'").select("o_orderkey", "o_totalprice", F.lit("old").alias("version"))
    source = orders.where(CHANGED_SQL).select(
        "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), F.lit("new").alias("version")
    )
    return target, source


@query("tbl_merge", MERGED)
def tbl_merge(spark, sf):
    return merge.merge_upsert(*_merge_sides(spark, sf), ["o_orderkey"])


@query("tbl_merge_stored", MERGED)
def tbl_merge_stored(spark, sf):
    """The same merge into a stored table."""
    target, source = _merge_sides(spark, sf)
    table = KeyedParquet(spark, scratch_path(spark, "orders"), ["o_orderkey"])
    table.overwrite(target)
    table.merge(source)
    return table.read()


@query(
    "tbl_merge_insert_only",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderstatus = 'P' THEN 'new' ELSE 'old' END AS version FROM orders""",
)
def tbl_merge_insert_only(spark, sf):
    return merge.merge_insert_only(*_merge_sides(spark, sf), ["o_orderkey"])


@query(
    "tbl_update_where",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'done' ELSE o_orderpriority END AS o_orderpriority,
         CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE o_totalprice END AS o_totalprice, o_orderstatus FROM orders""",
)
def tbl_update_where(spark, sf):
    orders = e.load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus")
    return merge.update_where(
        orders, F.col("o_orderstatus") == "P", {"o_orderpriority": F.lit("done"), "o_totalprice": F.lit(0.0)}
    )


SCD1 = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_extendedprice, l_partkey, l_suppkey) = 1"""


def line_changes(lines: DataFrame) -> DataFrame:
    return lines.select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey", F.col("l_shipdate").alias("seq")
    )


@query("cdc_scd1", SCD1)
def cdc_scd1(spark, sf):
    """Lines as a change feed keyed by order and line, sequenced by ship date."""
    changes = line_changes(e.load(spark, sf, "lineitem"))
    return merge.apply_changes(changes, ["l_orderkey", "l_linenumber"], "seq", ["seq"])


# -- loads -----------------------------------------------------------------


@query(
    "inc_watermark_load",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate > TIMESTAMP '1999-01-01' THEN o_totalprice + 1
         ELSE o_totalprice END AS o_totalprice, o_orderdate AS updated_date FROM orders""",
)
def inc_watermark_load(spark, sf):
    """Three runs: the orders up to 1999, the later ones, and one that finds nothing new."""
    base = scratch_path(spark, "incremental")
    stored = e.load(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("timestamp").alias("updated_date")
    )
    turn = F.lit("1999-01-01").cast("timestamp")
    later = stored.withColumn("o_totalprice", F.when(F.col("updated_date") > turn, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    target = KeyedParquet(spark, f"{base}/target", ["o_orderkey"])
    marks = loads.Watermarks(spark, f"{base}/control")
    for step, source in enumerate([stored.where(F.col("updated_date") <= turn), later, later]):
        loads.incremental_load(
            "orders",
            lambda after, source=source: source.where(F.col("updated_date") > F.lit(after)),
            target,
            marks,
            "updated_date",
            f"{base}/staging{step}",
        )
    return target.read().drop("ingestion_timestamp")


DAILY_LOAD = check(
    "raw_sales",
    """SELECT event_id, customer_id, quantity, unit_price, CAST(event_timestamp AS DATE) AS event_date,
         CAST(CAST(event_timestamp AS DATE) + CASE WHEN CAST(event_id AS INTEGER) % 7 = 0 THEN 3 ELSE 0 END AS VARCHAR)
           AS processing_date
       FROM raw_sales WHERE event_id IS NOT NULL AND customer_id IS NOT NULL AND quantity > 0 AND unit_price > 0
         AND event_timestamp IS NOT NULL""",
)


@query("dq_gate", DAILY_LOAD)
def dq_gate(spark, sf):
    """Every day loaded through read, clean, validate and write, a seventh of the events three
    days late; one day is loaded twice."""
    base = scratch_path(spark, "daily")
    late = F.when(F.col("event_id").cast("int") % 7 == 0, 3).otherwise(0)
    dated = e.raw_sales(spark, sf).where("event_timestamp IS NOT NULL")
    dated = dated.withColumn("date", F.date_add(F.to_date("event_timestamp"), late))
    sinks.write_partitioned(dated, f"{base}/in", "date")
    days = [str(r[0]) for r in dated.select("date").distinct().orderBy("date").collect()]  # one row per day
    for day in [*days, days[len(days) // 2]]:
        loads.run_daily_sales(spark, f"{base}/in", f"{base}/out", day)
    return spark.read.parquet(f"{base}/out").select(
        "event_id", "customer_id", "quantity", "unit_price", "event_date", F.col("processing_date").cast("string").alias("processing_date")
    )


# -- layout ----------------------------------------------------------------


def _parts(spark) -> int:
    return max(10, shuffle_width(spark))


@query("lay_hash", "SELECT count(*) AS n_rows, TRUE AS every_partition_listed, TRUE AS key_in_one_partition FROM events")
def lay_hash(spark, sf):
    """Hash layout: rows per partition add up, and a key is in one partition."""
    parts = _parts(spark)
    laid = layout.hash_layout(e.load(spark, sf, "events"), parts, "user_id")
    counts = layout.partition_counts(laid, parts).agg(F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)) == parts)
    homes = laid.select("user_id", F.spark_partition_id().alias("p")).distinct().groupBy("user_id").count()
    apart = homes.agg((F.max("count") == 1).alias("one"))
    return counts.toDF("n_rows", "every_partition_listed").withColumn("key_in_one_partition", apart.scalar())


@query("lay_range", "SELECT count(*) AS n_rows, TRUE AS every_partition_listed, TRUE AS ranges_apart FROM events")
def lay_range(spark, sf):
    """Range layout: rows per partition add up, and the ranges do not overlap."""
    parts = _parts(spark)
    laid = layout.range_layout(e.load(spark, sf, "events"), parts, "ts")
    counts = layout.partition_counts(laid, parts).agg(F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)) == parts)
    ranges = laid.groupBy(F.spark_partition_id().alias("p")).agg(F.min("ts").alias("low"), F.max("ts").alias("high"))
    before = F.lag("high").over(Window.orderBy("p"))  # a row per partition
    apart = ranges.select(F.coalesce(before <= F.col("low"), F.lit(True)).alias("ok")).agg(F.bool_and("ok").alias("all"))
    return counts.toDF("n_rows", "every_partition_listed").withColumn("ranges_apart", apart.scalar())


@query("lay_stats", "SELECT TRUE AS consistent, TRUE AS holds_all_rows FROM events LIMIT 1")
def lay_stats(spark, sf):
    """The spread of a layout: difference of the extremes, and extremes that fit all rows."""
    parts, events = _parts(spark), e.load(spark, sf, "events")
    spread = layout.partition_spread(layout.hash_layout(events, parts, "user_id"), parts)
    total = events.agg(F.count(F.lit(1)).alias("n"))
    low, high = F.col("min_rows") * parts, F.col("max_rows") * parts
    fits = (low <= total.scalar()) & (total.scalar() <= high)
    return spread.select(
        ((F.col("skew") == F.col("max_rows") - F.col("min_rows")) & (F.col("partitions") == parts)).alias("consistent"),
        fits.alias("holds_all_rows"),
    )


LINES = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem"


def _lines(spark, sf):
    return e.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def _small_files(spark, sf, table: str) -> int:
    """A fragmented layout: files of 32 MB, and several of them for a small table too."""
    return layout.files_for(spark, f"{sf}/{table}.parquet", 32 * 1024 * 1024, at_least=32)


def _clustered_files(spark, sf) -> int:
    return layout.files_for(spark, f"{sf}/lineitem.parquet", at_least=16)


@query("lay_compact", LINES)
def lay_compact(spark, sf):
    """Many small files rewritten as few."""
    base = scratch_path(spark, "compact")
    _lines(spark, sf).repartition(_small_files(spark, sf, "lineitem")).write.parquet(f"{base}/small")
    layout.compact(spark, f"{base}/small", f"{base}/large")
    return spark.read.parquet(f"{base}/large")


@query("lay_cluster", LINES)
def lay_cluster(spark, sf):
    path = scratch_path(spark, "clustered")
    layout.cluster(_lines(spark, sf), ["l_partkey", "l_suppkey"], _clustered_files(spark, sf)).write.parquet(path)
    return spark.read.parquet(path)


@query(
    "lay_cluster_load",
    "SELECT count(*) AS n, sum(round(l_extendedprice * 100)) AS total, TRUE AS most_files_untouched, TRUE AS files_listed FROM lineitem",
)
def lay_cluster_load(spark, sf):
    """The newest tenth of the orders loaded into a clustered table of the rest."""
    lines = _lines(spark, sf)
    newest = lines.agg(F.percentile_approx("l_orderkey", 0.9, 1000)).first()[0]
    rows = max(1, lines.count() // (2 * _clustered_files(spark, sf)))
    table = ClusteredParquet(spark, scratch_path(spark, "clustered"), ["l_orderkey", "l_partkey"], rows)
    table.create(lines.where(F.col("l_orderkey") <= newest))
    done = table.load(lines.where(F.col("l_orderkey") > newest))
    listed = table.files().agg(F.sum("n").alias("n"))
    found = table.read().agg(F.count("*").alias("n"), F.sum(e.minor("l_extendedprice")).alias("total"))
    kept = F.lit(done.files_untouched > done.files_rewritten)
    return found.select("n", "total", kept.alias("most_files_untouched"), (F.col("n") == listed.scalar()).alias("files_listed"))


LOOKUP = "count(*) AS n, sum(round(l_extendedprice * 100)) AS total FROM lineitem WHERE l_partkey = 1000"


@query("lay_point_lookup", f"SELECT 'plain' AS layout, {LOOKUP} UNION ALL SELECT 'clustered', {LOOKUP}")
def lay_point_lookup(spark, sf):
    """Count and sum for one part, on the table as many unordered files and clustered."""
    base, lines = scratch_path(spark, "lookup"), _lines(spark, sf)
    lines.repartition(_small_files(spark, sf, "lineitem")).write.parquet(f"{base}/plain")
    layout.cluster(lines, ["l_partkey", "l_suppkey"], _clustered_files(spark, sf)).write.parquet(f"{base}/clustered")
    found = None
    for name in ("plain", "clustered"):
        hits = spark.read.parquet(f"{base}/{name}").where("l_partkey = 1000")
        one = hits.agg(F.lit(name).alias("layout"), F.count("*").alias("n"), F.sum(e.minor("l_extendedprice")).alias("total"))
        found = one if found is None else found.unionByName(one)
    return found


@query(
    "lay_bloom_lookup",
    """SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_absent, TRUE AS absent_skipped, TRUE AS found_skips
       FROM lineitem WHERE l_orderkey = (SELECT max(l_orderkey) // 2 * 2 FROM lineitem)""",
)
def lay_bloom_lookup(spark, sf):
    """Orders looked up in files whose ranges all enclose the key: with even keys stored, one that is there and an odd one
    that is not. Row groups are skipped by their Bloom filters."""
    path, lines = scratch_path(spark, "bloom"), _lines(spark, sf)
    files = _clustered_files(spark, sf)
    stored = lines.withColumn("key", F.col("l_orderkey") * 2).repartition(files, "l_orderkey", "l_linenumber")
    rows, highest = lines.agg(F.count("*"), F.max("l_orderkey")).first()
    stored.write.options(**layout.bloom_options({"key": rows // files}, 0.001)).parquet(path)
    wanted = highest // 2 * 2
    n, read = layout.rows_scanned(spark.read.parquet(path).where(F.col("key") == 2 * wanted).select("key"))
    n_absent, read_absent = layout.rows_scanned(spark.read.parquet(path).where(F.col("key") == wanted + 1).select("key"))
    facts = lines.agg(F.count("*").alias("total"))
    return facts.select(
        F.lit(n).cast("bigint").alias("n"),
        F.lit(n_absent).cast("bigint").alias("n_absent"),
        (F.lit(read_absent) * 4 <= F.col("total")).alias("absent_skipped"),
        (F.lit(read) * 4 <= F.col("total") * 3).alias("found_skips"),
    )


@query("lay_compact_partition", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def lay_compact_partition(spark, sf):
    path = scratch_path(spark, "by-status")
    orders = e.load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    orders.repartition(_small_files(spark, sf, "orders")).write.partitionBy("o_orderstatus").parquet(path)
    layout.compact_partition(spark, path, "o_orderstatus", "F", ["o_orderkey"], staging=scratch_path(spark, "staged"))
    return spark.read.parquet(path)


@query(
    "cch_levels",
    """SELECT level, high, low FROM (SELECT count(*) FILTER (value > 50) AS high, count(*) FILTER (value < 10) AS low
         FROM events), (VALUES ('MEMORY_ONLY'), ('MEMORY_AND_DISK'), ('DISK_ONLY')) v(level)""",
)
def cch_levels(spark, sf):
    """Two counts over the same kept projection, at each storage level."""
    rows = []
    for level in LEVELS:
        with kept(e.load(spark, sf, "events").select("value"), level) as values:
            rows.append((level, values.where("value > 50").count(), values.where("value < 10").count()))
    return spark.createDataFrame(rows, "level STRING, high BIGINT, low BIGINT")
