"""Registered queries: windows, features, ordering, sets, surrogate keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.operators import history
from stratalake.operators.dedup import drop_duplicate_keys, latest_per_key, newest_batch
from stratalake.operators.quality import primary_key_violations, revenue_change
from stratalake.operators.ranges import add_dense_rank, add_row_number
from stratalake.plans import medallion
from stratalake.plans.sales_metrics import order_feature_table, sales_daily_metrics
from stratalake.queries import entities as e
from stratalake.queries.entities import check
from stratalake.queries.registry import query


def _stamp():
    return F.lit("2024-02-01").cast("timestamp")



SILVER_CUSTOMERS = check(
    "bronze_customers",
    """SELECT trim(customer_id) AS customer_id, lower(trim(email)) AS email, trim(name) AS name, city, state, country,
         CAST(signup_date AS DATE) AS signup_date, source_file, TIMESTAMP '2024-02-01' AS silver_loaded_ts_utc
       FROM bronze_customers
       QUALIFY row_number() OVER (PARTITION BY trim(customer_id) ORDER BY bronze_loaded_ts_utc DESC) = 1""",
)


@query("win_dedup_latest", SILVER_CUSTOMERS)
def win_dedup_latest(spark, sf):
    return medallion.silver_customers(e.bronze_customers(spark, sf), _stamp())


@query("slv_customers_sql", SILVER_CUSTOMERS)
def slv_customers_sql(spark, sf):
    return medallion.silver_customers(e.bronze_customers(spark, sf), _stamp())


@query(
    "slv_orders_sql",
    check(
        "bronze_orders",
        """SELECT trim(order_id) AS order_id, trim(customer_id) AS customer_id, CAST(order_date AS DATE) AS order_date,
             CAST(order_total AS DOUBLE) AS order_total, order_status, source_file,
             TIMESTAMP '2024-02-01' AS silver_loaded_ts_utc
           FROM bronze_orders
           QUALIFY row_number() OVER (PARTITION BY trim(order_id) ORDER BY bronze_loaded_ts_utc DESC) = 1""",
    ),
)
def slv_orders_sql(spark, sf):
    return medallion.silver_orders(e.bronze_orders(spark, sf), _stamp())


@query(
    "slv_products_sql",
    check(
        "bronze_products",
        """SELECT trim(product_id) AS product_id, trim(product_name) AS product_name, trim(category) AS category,
             subcategory, CAST(price AS DOUBLE) AS price, source_file, TIMESTAMP '2024-02-01' AS silver_loaded_ts_utc
           FROM bronze_products
           QUALIFY row_number() OVER (PARTITION BY trim(product_id) ORDER BY bronze_loaded_ts_utc DESC) = 1""",
    ),
)
def slv_products_sql(spark, sf):
    return medallion.silver_products(e.bronze_products(spark, sf), _stamp())


SILVER_ITEMS = check(
    "bronze_items",
    """SELECT trim(order_item_id) AS order_item_id, trim(order_id) AS order_id, trim(product_id) AS product_id,
         CAST(quantity AS INTEGER) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price, source_file,
         TIMESTAMP '2024-02-01' AS silver_loaded_ts_utc
       FROM bronze_items
       QUALIFY dense_rank() OVER (PARTITION BY trim(order_id) ORDER BY bronze_loaded_ts_utc DESC) = 1""",
)


@query("slv_order_items_sql", SILVER_ITEMS)
def slv_order_items_sql(spark, sf):
    return medallion.silver_order_items(e.bronze_items(spark, sf), _stamp())


@query(
    "win_dedup_latest_batch",
    check(
        "items",
        """SELECT * FROM items
           QUALIFY dense_rank() OVER (PARTITION BY order_id ORDER BY bronze_loaded_ts_utc DESC) = 1""",
    ),
)
def win_dedup_latest_batch(spark, sf):
    return newest_batch(e.items(spark, sf), ["order_id"], "bronze_loaded_ts_utc")


@query(
    "flt_qualify",
    check(
        "ord",
        """SELECT customer_id, order_id, order_date FROM ord
           QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id DESC) = 1""",
    ),
)
def flt_qualify(spark, sf):
    orders = e.orders(spark, sf).select("customer_id", "order_id", "order_date")
    return latest_per_key(orders, ["customer_id"], [F.desc("order_date"), F.desc("order_id")])


# -- surrogate keys --------------------------------------------------------

DIM_CUSTOMER = check(
    "customers",
    """SELECT row_number() OVER (ORDER BY CAST(customer_id AS VARCHAR)) AS customer_sk,
         CAST(customer_id AS VARCHAR) AS customer_id, name, email, city, state, country, signup_date FROM customers""",
)


def _text_customers(spark, sf):
    return e.customers(spark, sf).withColumn("customer_id", F.col("customer_id").cast("string"))


@query("dim_customer", DIM_CUSTOMER)
def dim_customer(spark, sf):
    return medallion.dim_customer(_text_customers(spark, sf))


@query(
    "dim_product",
    check(
        "products",
        """SELECT row_number() OVER (ORDER BY product_id) AS product_sk, product_id, product_name, category, price
           FROM products""",
    ),
)
def dim_product(spark, sf):
    return medallion.dim_product(e.products(spark, sf))


@query(
    "win_surrogate_rn",
    "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_sk, o_orderkey, o_orderdate FROM orders",
)
def win_surrogate_rn(spark, sf):
    orders = e.load(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return add_row_number(orders, ["o_orderdate", "o_orderkey"], "order_sk", ranges=24)


@query(
    "win_surrogate_dense",
    """SELECT dense_rank() OVER (ORDER BY l_orderkey, l_linenumber) AS sale_id, l_orderkey, l_linenumber, l_partkey,
         l_quantity FROM lineitem""",
)
def win_surrogate_dense(spark, sf):
    items = e.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return add_dense_rank(items, ["l_orderkey", "l_linenumber"], "sale_id", ranges=24)


# -- order features --------------------------------------------------------

ORDER_W = "OVER (PARTITION BY customer_id ORDER BY order_date, order_id)"
BEFORE_W = "OVER (PARTITION BY customer_id ORDER BY order_date, order_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
FEATURE_SQL = {
    "label_next_order_amount": f"lead(order_amount) {ORDER_W}",
    "last_order_amount": f"lag(order_amount) {ORDER_W}",
    "days_since_prev_order": f"CAST(date_diff('day', lag(order_date) {ORDER_W}, order_date) AS INTEGER)",
    "purchase_count_to_date": f"CAST(count(*) {BEFORE_W} AS INTEGER)",
    "hist_avg_purchase": f"sum(order_amount) {BEFORE_W} / count(order_amount) {BEFORE_W}",
    "total_spend_to_date": f"sum(order_amount) {BEFORE_W}",
}
BASE = "base AS (SELECT customer_id, order_id, order_date, total_amount AS order_amount FROM ord)"


def _base(spark, sf):
    return e.orders(spark, sf).select("customer_id", "order_id", "order_date", F.col("total_amount").alias("order_amount"))


def _feature(name: str, column: str, add):
    sql = check("ord", f", {BASE} SELECT *, {FEATURE_SQL[column]} AS {column} FROM base")
    query(name, sql)(lambda spark, sf: add(_base(spark, sf)))


_feature("win_lead_label", "label_next_order_amount", history.add_label_next_order_amount)
_feature("win_lag_amount", "last_order_amount", history.add_last_order_amount)
_feature("win_days_since", "days_since_prev_order", history.add_days_since_prev_order)
_feature("win_count_to_date", "purchase_count_to_date", history.add_purchase_count_to_date)
_feature("win_avg_to_date", "hist_avg_purchase", history.add_hist_avg_purchase)
_feature("win_sum_to_date", "total_spend_to_date", history.add_total_spend_to_date)

FEATURE_TABLE = check(
    "ord",
    f""", {BASE} SELECT CAST(customer_id AS VARCHAR) AS customer_id, CAST(order_id AS VARCHAR) AS order_id, order_date,
          order_amount, {', '.join(f'{v} AS {k}' for k, v in FEATURE_SQL.items())}
        FROM (SELECT CAST(customer_id AS VARCHAR) AS customer_id, CAST(order_id AS VARCHAR) AS order_id, order_date,
                order_amount FROM base) t""",
)


@query("feat_order_store", FEATURE_TABLE)
def feat_order_store(spark, sf):
    return order_feature_table(e.orders(spark, sf))


@query("feat_order_store_hot", FEATURE_TABLE)
def feat_order_store_hot(spark, sf):
    """The same table with the limit for a hot customer set low, so that many are split."""
    return order_feature_table(e.orders(spark, sf), hot_rows=12)


@query(
    "feat_pk_check",
    check(
        "ord",
        "SELECT customer_id, order_date, count(*) AS n_rows FROM ord GROUP BY 1, 2 HAVING count(*) > 1",
    ),
)
def feat_pk_check(spark, sf):
    return primary_key_violations(e.orders(spark, sf), ["customer_id", "order_date"])


@query(
    "win_lag_global",
    check(
        "daily",
        """SELECT date, total_revenue, lag(total_revenue) OVER (ORDER BY date) AS prev_revenue,
             round((total_revenue - lag(total_revenue) OVER (ORDER BY date)) * 100.0::DOUBLE
                   / lag(total_revenue) OVER (ORDER BY date), 2) + 0.0 AS revenue_change_pct
           FROM daily""",
    ),
)
def win_lag_global(spark, sf):
    return revenue_change(sales_daily_metrics(e.orders(spark, sf), e.items(spark, sf)))


# -- order and limit -------------------------------------------------------


@query("ord_sort", check("ord", "SELECT order_id, customer_id, order_date FROM ord ORDER BY order_date DESC, order_id"))
def ord_sort(spark, sf):
    return e.orders(spark, sf).select("order_id", "customer_id", "order_date").orderBy(F.desc("order_date"), "order_id")


@query(
    "ord_topk",
    check("ord", "SELECT order_id, total_amount FROM ord ORDER BY total_amount DESC, order_id LIMIT 10"),
)
def ord_topk(spark, sf):
    return e.orders(spark, sf).select("order_id", "total_amount").orderBy(F.desc("total_amount"), "order_id").limit(10)


@query("ord_limit", "SELECT least(count(*), 10) AS n_rows, least(count(*), 10) AS n_known FROM orders")
def ord_limit(spark, sf):
    """Any ten rows: ten of them, all different and from the table."""
    some = e.orders(spark, sf).limit(10).select("order_id").distinct()
    known = some.join(e.orders(spark, sf), "order_id", "left_semi").agg(F.count(F.lit(1)).alias("n_known"))
    return some.agg(F.count(F.lit(1)).alias("n_rows"), F.max(known.scalar()).alias("n_known"))


@query(
    "fn_desc",
    check("products", "SELECT product_id, price FROM products ORDER BY price DESC NULLS LAST, product_id"),
)
def fn_desc(spark, sf):
    return e.products(spark, sf).select("product_id", "price").orderBy(F.col("price").desc_nulls_last(), "product_id")


# -- sets ------------------------------------------------------------------


@query(
    "set_union_by_name",
    """SELECT c_custkey AS party_id, c_name AS name, 'customer' AS kind FROM customer
       UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier""",
)
def set_union_by_name(spark, sf):
    c = e.load(spark, sf, "customer").select(
        F.col("c_custkey").alias("party_id"), F.col("c_name").alias("name"), F.lit("customer").alias("kind")
    )
    s = e.load(spark, sf, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("party_id")
    )
    return c.unionByName(s)


@query("set_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def set_distinct(spark, sf):
    return e.load(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query(
    "set_drop_duplicates",
    """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
                  l_shipdate) = 1""",
)
def set_drop_duplicates(spark, sf):
    return drop_duplicate_keys(e.load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
