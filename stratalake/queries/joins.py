"""Registered queries: joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.operators import intervals, joins
from stratalake.operators.dedup import duplicate_keys
from stratalake.operators.quality import missing_dimensions
from stratalake.plans import loads, medallion, monitoring
from stratalake.plans.sales_metrics import daily_item_metrics, daily_order_metrics
from stratalake.queries import entities as e
from stratalake.queries.entities import check
from stratalake.queries.registry import query
from stratalake.schemas import REST_USERS
from stratalake.sources import rest


@query(
    "join_inner",
    check(
        "ord customers",
        "SELECT order_id, order_date, name AS customer_name, order_total FROM ord JOIN customers USING (customer_id)",
    ),
)
def join_inner(spark, sf):
    joined = e.orders(spark, sf).join(e.customers(spark, sf), "customer_id", "inner")
    return joined.select("order_id", "order_date", F.col("name").alias("customer_name"), "order_total")


@query(
    "join_left",
    check(
        "items products",
        """SELECT order_item_id, line_total, product_id, product_name FROM items
           LEFT JOIN (SELECT * REPLACE (CASE WHEN category = 'PROMO' THEN -product_id ELSE product_id END AS product_id)
             FROM products) p USING (product_id)""",
    ),
)
def join_left(spark, sf):
    return e.items(spark, sf).join(_moved(e.products(spark, sf)), "product_id", "left").select("order_item_id", "line_total", "product_id", "product_name")


def _moved(products):
    """All products, those of one category under keys that no line has."""
    return products.withColumn("product_id", F.when(F.col("category") == "PROMO", -F.col("product_id")).otherwise(F.col("product_id")))


def _star(spark, sf):
    customers = medallion.dim_customer(e.customers(spark, sf))
    products = medallion.dim_product(e.products(spark, sf))
    dates = medallion.dim_date(spark, "1990-01-01", "2009-12-31")
    return medallion.fact_sales(e.items(spark, sf), e.orders(spark, sf), customers, _moved(products), dates)


FACT = check(
    "items ord customers products",
    """, c AS (SELECT row_number() OVER (ORDER BY customer_id) AS customer_sk, customer_id FROM customers),
    p AS (SELECT * REPLACE (CASE WHEN category = 'PROMO' THEN -product_id ELSE product_id END AS product_id)
          FROM (SELECT row_number() OVER (ORDER BY product_id) AS product_sk, product_id, category FROM products)),
    d AS (SELECT row_number() OVER (ORDER BY v) AS date_sk, v FROM (SELECT CAST(unnest(generate_series(
            TIMESTAMP '1990-01-01', TIMESTAMP '2009-12-31', INTERVAL 1 DAY)) AS DATE) AS v)),
    fact AS (SELECT dense_rank() OVER (ORDER BY i.order_id, i.order_item_id) AS sale_id, i.order_id, i.order_item_id,
          d.date_sk, p.product_sk, c.customer_sk, i.quantity, i.unit_price, i.quantity * i.unit_price AS line_total
        FROM items i JOIN ord o ON i.order_id = o.order_id LEFT JOIN c ON o.customer_id = c.customer_id
        LEFT JOIN p ON i.product_id = p.product_id LEFT JOIN d ON o.order_date = d.v)""",
)


@query("join_star", f"{FACT} SELECT * FROM fact")
def join_star(spark, sf):
    return _star(spark, sf)


@query(
    "dq_missing_dims",
    f'{FACT} SELECT count(*) AS "MissingDimensionAttributes" FROM fact WHERE product_sk IS NULL OR customer_sk IS NULL',
)
def dq_missing_dims(spark, sf):
    return missing_dimensions(_star(spark, sf))


@query(
    "dq_duplicates",
    f"{FACT} SELECT sale_id, count(sale_id) AS duplicate_count FROM fact GROUP BY 1 HAVING count(sale_id) > 1",
)
def dq_duplicates(spark, sf):
    return duplicate_keys(_star(spark, sf), ["sale_id"])


@query(
    "join_aggs",
    check(
        "ord items",
        """, a AS (SELECT order_date AS date, sum(total_amount) AS total_revenue FROM ord GROUP BY 1),
           b AS (SELECT order_date AS date, CAST(sum(quantity) AS BIGINT) AS total_items_sold
                 FROM items JOIN ord USING (order_id) GROUP BY 1)
           SELECT a.date, total_revenue, total_items_sold FROM a LEFT JOIN b USING (date)""",
    ),
)
def join_aggs(spark, sf):
    orders, items = e.orders(spark, sf), e.items(spark, sf)
    both = daily_order_metrics(orders).join(daily_item_metrics(items, orders), "date", "left")
    return both.select("date", "total_revenue", "total_items_sold")


@query(
    "join_validity",
    check(
        "usage list_prices",
        """SELECT usage_start_time, u.sku_name, usage_quantity, default_price
           FROM usage u JOIN list_prices p ON u.cloud = p.cloud AND u.sku_name = p.sku_name
             AND u.usage_start_time >= p.price_start_time
             AND (u.usage_end_time <= p.price_end_time OR p.price_end_time IS NULL)""",
    ),
)
def join_validity(spark, sf):
    prices = e.list_prices(spark, sf).withColumn("default_price", F.col("pricing.default")).drop("pricing")
    matched = intervals.validity_join(
        e.usage(spark, sf),
        prices,
        ["cloud", "sku_name"],
        at=F.col("usage_start_time"),
        start=F.col("price_start_time"),
        end=F.col("price_end_time"),
        ends_before=F.col("usage_end_time"),
    )
    return matched.select("usage_start_time", "sku_name", "usage_quantity", "default_price")


@query(
    "join_validity_halfopen",
    check(
        "usage list_prices",
        """SELECT usage_date, usage_start_time, u.sku_name, effective_price
           FROM usage u JOIN list_prices p ON u.sku_name = p.sku_name
             AND u.usage_date >= CAST(p.price_start_time AS DATE)
             AND (p.price_end_time IS NULL OR u.usage_date < CAST(p.price_end_time AS DATE))""",
    ),
)
def join_validity_halfopen(spark, sf):
    prices = e.list_prices(spark, sf).select(
        "sku_name",
        F.to_date("price_start_time").alias("d0"),
        F.to_date("price_end_time").alias("d1"),
        F.col("pricing.effective_list.default").alias("effective_price"),
    )
    matched = intervals.validity_join(
        e.usage(spark, sf), prices, ["sku_name"], at=F.col("usage_date"), start=F.col("d0"), end=F.col("d1"),
    )
    return matched.select("usage_date", "usage_start_time", "sku_name", "effective_price")


@query(
    "join_overlap",
    """WITH transit AS (SELECT o_custkey, l_orderkey, l_linenumber, l_shipdate, l_shipdate + to_days(l_linenumber) AS arrives
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
       SELECT o.o_orderkey, t.l_orderkey, t.l_linenumber FROM orders o JOIN transit t ON o.o_custkey = t.o_custkey
         AND o.o_orderdate <= t.arrives AND t.l_shipdate <= o.o_orderdate + INTERVAL 30 DAYS""",
)
def join_overlap(spark, sf):
    """Shipments that were under way within thirty days of any order of the same customer."""
    orders = e.load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    owner = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    transit = e.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate").join(owner, "l_orderkey")
    arrives = F.col("l_shipdate") + F.make_dt_interval(F.col("l_linenumber"))
    met = intervals.overlap_join(
        orders, transit, ["o_custkey"],
        (F.col("o_orderdate"), F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")), (F.col("l_shipdate"), arrives),
    )
    return met.select("o_orderkey", "l_orderkey", "l_linenumber")


@query(
    "join_dedup_side",
    check(
        "timeline jobs",
        """SELECT t.run_id, t.job_id, j.name FROM timeline t
           JOIN (SELECT * FROM jobs QUALIFY row_number() OVER (PARTITION BY workspace_id, job_id
                   ORDER BY change_time DESC) = 1) j ON t.workspace_id = j.workspace_id AND t.job_id = j.job_id""",
    ),
)
def join_dedup_side(spark, sf):
    current = monitoring.current_jobs(e.jobs(spark, sf))
    timeline = e.job_run_timeline(spark, sf)
    return timeline.join(current, ["workspace_id", "job_id"]).select("run_id", "job_id", "name")


SUPPLIER_SQL = """SELECT l_orderkey, l_linenumber, s_name, l_extendedprice
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""


def _supplied(spark, sf):
    lines = e.load(spark, sf, "lineitem").withColumnRenamed("l_suppkey", "suppkey")
    suppliers = e.load(spark, sf, "supplier").select(F.col("s_suppkey").alias("suppkey"), "s_name")
    return lines, suppliers


def _four(df):
    return df.select("l_orderkey", "l_linenumber", "s_name", "l_extendedprice")


@query("join_broadcast", SUPPLIER_SQL)
def join_broadcast(spark, sf):
    return _four(joins.join_small(*_supplied(spark, sf), "suppkey"))


@query("join_adaptive", SUPPLIER_SQL)
def join_adaptive(spark, sf):
    return _four(_supplied(spark, sf)[0].join(_supplied(spark, sf)[1], "suppkey"))


@query("join_anti", "SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def join_anti(spark, sf):
    big = e.load(spark, sf, "orders").where("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return e.load(spark, sf, "customer").join(big, "c_custkey", "left_anti").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("join_cross", "SELECT s_suppkey, s_name, salt_val FROM supplier, range(10) t(salt_val)")
def join_cross(spark, sf):
    return joins.replicate(e.load(spark, sf, "supplier").select("s_suppkey", "s_name"), 10)


# -- salting: half of all lines are moved to supplier 1 ---------------------

SKEWED_LINES = """skewed AS (SELECT CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE l_suppkey END AS suppkey,
    l_partkey, round(l_extendedprice * 100) AS amount FROM lineitem)"""
SKEWED_SUM = f"""WITH {SKEWED_LINES} SELECT suppkey, s_name, count(*) AS n, sum(amount) AS total_amount
    FROM skewed JOIN supplier ON suppkey = s_suppkey GROUP BY 1, 2"""


def _skewed(spark, sf):
    lines = e.load(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 2 == 0, 1).otherwise(F.col("l_suppkey")).alias("suppkey"),
        "l_orderkey",
        "l_partkey",
        e.minor("l_extendedprice").alias("amount"),
    )
    return lines, e.load(spark, sf, "supplier").select(F.col("s_suppkey").alias("suppkey"), "s_name")


def _sum(df):
    return df.groupBy("suppkey", "s_name").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total_amount"))


@query("join_salted_selective", SKEWED_SUM)
def join_salted_selective(spark, sf):
    return _sum(joins.join_salted_selective(*_skewed(spark, sf), "suppkey"))


@query(
    "join_salted_full",
    f"""WITH {SKEWED_LINES} SELECT suppkey, s_name, count(*) AS n, sum(amount) AS total_amount,
        count(DISTINCT l_partkey) AS parts FROM skewed LEFT JOIN supplier ON suppkey = s_suppkey GROUP BY 1, 2""",
)
def join_salted_full(spark, sf):
    joined = joins.join_salted_full(*_skewed(spark, sf), "suppkey")
    return joined.groupBy("suppkey", "s_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total_amount"), F.countDistinct("l_partkey").alias("parts")
    )


@query("join_skew_aqe", SKEWED_SUM)
def join_skew_aqe(spark, sf):
    lines, suppliers = _skewed(spark, sf)
    return _sum(lines.join(suppliers, "suppkey"))


# -- sales with products, posts with authors -------------------------------


@query(
    "sales_enriched",
    check(
        "items products",
        """SELECT order_item_id, i.product_id, quantity, unit_price, bronze_loaded_ts_utc AS sale_date,
             quantity * unit_price AS total_amount, year(bronze_loaded_ts_utc) AS sale_year,
             month(bronze_loaded_ts_utc) AS sale_month, product_name, category, subcategory, price
           FROM items i LEFT JOIN products p ON i.product_id = p.product_id""",
    ),
)
def sales_enriched(spark, sf):
    sold = e.items(spark, sf).select(
        "order_item_id", "product_id", "quantity", "unit_price", F.col("bronze_loaded_ts_utc").alias("sale_date")
    )
    return loads.enrich_sales(sold, e.products(spark, sf))


@query(
    "posts_with_authors",
    """SELECT event_id AS post_id, event_type AS title, c_name AS author_name, c_mktsegment AS company_name, n_name AS city
       FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def posts_with_authors(spark, sf):
    """Events as posts, customers as users, joined by a view in SQL text."""
    posts = e.load(spark, sf, "events").select(
        F.col("event_id").alias("post_id"), "user_id", F.col("event_type").alias("title"), F.col("props").alias("content")
    )
    users = e.customers(spark, sf).select(
        F.col("customer_id").alias("user_id"), "name", F.col("segment").alias("company_name"), "city"
    )
    return rest.posts_with_authors(posts, users)


@query(
    "src_nested_frame",
    """SELECT c_custkey AS user_id, c_name AS name, lower(c_name) AS username, n_name AS city,
         CAST(c_nationkey AS VARCHAR) AS latitude, CAST(n_regionkey AS VARCHAR) AS longitude, c_mktsegment AS company_name
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def src_nested_frame(spark, sf):
    """Customers written as nested JSON records, read back with an explicit schema."""
    c, n = e.load(spark, sf, "customer"), e.load(spark, sf, "nation")
    record = F.to_json(
        F.struct(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.lower("c_name").alias("username"),
            F.struct(
                F.col("n_name").alias("city"),
                F.struct(F.col("c_nationkey").alias("lat"), F.col("n_regionkey").alias("lng")).alias("geo"),
            ).alias("address"),
            F.struct(F.col("c_mktsegment").alias("name")).alias("company"),
        )
    )
    raw = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.from_json(record, REST_USERS).alias("r"))
    return rest.flatten_users(raw.select("r.*")).drop("email", "phone")
