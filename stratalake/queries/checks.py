"""Registered queries: data quality, cleaning, quarantine, alerts, governance."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.functions import governance as gov
from stratalake.operators import quality as q
from stratalake.plans import loads, medallion
from stratalake.plans.sales_metrics import geographic_sales, order_feature_table, sales_daily_metrics
from stratalake.queries import entities as e
from stratalake.queries.aggregates import GEO, _geo_orders
from stratalake.queries.entities import check
from stratalake.queries.registry import query
from stratalake.session import scratch_path

SALES_RULES = {
    "has_event": "event_id IS NOT NULL",
    "has_customer": "customer_id IS NOT NULL",
    "positive_quantity": "quantity > 0",
    "positive_price": "unit_price > 0",
}
SALES_OK = "coalesce(event_id IS NOT NULL AND customer_id IS NOT NULL AND quantity > 0 AND unit_price > 0, FALSE)"


@query(
    "dq_expect",
    check(
        "raw_sales",
        """SELECT 'has_event' AS rule, count(*) FILTER (event_id IS NULL) AS failed, count(*) AS total FROM raw_sales
           UNION ALL SELECT 'has_customer', count(*) FILTER (customer_id IS NULL), count(*) FROM raw_sales
           UNION ALL SELECT 'positive_quantity', count(*) FILTER (NOT coalesce(quantity > 0, FALSE)), count(*) FROM raw_sales
           UNION ALL SELECT 'positive_price', count(*) FILTER (NOT coalesce(unit_price > 0, FALSE)), count(*) FROM raw_sales""",
    ),
)
def dq_expect(spark, sf):
    return q.violations(e.raw_sales(spark, sf), SALES_RULES)


@query("dq_expect_or_drop", check("raw_sales", "SELECT event_id, quantity FROM raw_sales WHERE quantity > 0"))
def dq_expect_or_drop(spark, sf):
    return q.expect_or_drop(e.raw_sales(spark, sf), "positive", "quantity > 0").select("event_id", "quantity")


@query(
    "dq_expect_all_or_drop",
    check("raw_sales", f"SELECT event_id, customer_id, quantity, unit_price FROM raw_sales WHERE {SALES_OK}"),
)
def dq_expect_all_or_drop(spark, sf):
    kept = q.expect_all_or_drop(e.raw_sales(spark, sf), SALES_RULES)
    return kept.select("event_id", "customer_id", "quantity", "unit_price")


@query(
    "dq_expect_all_or_fail",
    check("items", "SELECT order_item_id, order_id, product_id, quantity, unit_price FROM items"),
)
def dq_expect_all_or_fail(spark, sf):
    items = e.items(spark, sf).select("order_item_id", "order_id", "product_id", "quantity", "unit_price")
    return q.expect_all_or_fail(items, q.rules_for("order_items"))


@query(
    "dq_rules_registry",
    check(
        "ord",
        """SELECT 'valid_order_id' AS rule, count(*) FILTER (order_id IS NULL) AS failed, count(*) AS total FROM ord
           UNION ALL SELECT 'valid_customer_id', count(*) FILTER (customer_id IS NULL), count(*) FROM ord
           UNION ALL SELECT 'valid_order_total', count(*) FILTER (NOT total_amount > 0), count(*) FROM ord""",
    ),
)
def dq_rules_registry(spark, sf):
    return q.violations(e.orders(spark, sf), q.rules_for("orders"))


@query(
    "dq_incomplete_dim",
    check(
        "products",
        """SELECT product_id, product_name, category, price FROM (SELECT product_id, product_name,
             CASE WHEN product_id % 7 <> 0 THEN category END AS category,
             CASE WHEN product_id % 11 <> 0 THEN price END AS price FROM products)
           WHERE product_name IS NULL OR category IS NULL OR price IS NULL""",
    ),
)
def dq_incomplete_dim(spark, sf):
    dim = e.products(spark, sf).select(
        "product_id",
        "product_name",
        F.when(F.col("product_id") % 7 != 0, F.col("category")).alias("category"),
        F.when(F.col("product_id") % 11 != 0, F.col("price")).alias("price"),
    )
    return q.incomplete_rows(dim, ["product_name", "category", "price"])


@query(
    "dq_freshness",
    f"""SELECT max(ts) AS last_altered, max(ts) < TIMESTAMP '{e.AS_OF}' - INTERVAL 3 DAY AS is_stale FROM events""",
)
def dq_freshness(spark, sf):
    return q.freshness(e.load(spark, sf, "events"), "ts", e.as_of())


CLEAN_SQL = check(
    "raw_sales",
    """SELECT event_id, customer_id, product_id, quantity, unit_price,
         quantity * unit_price * CASE upper(trim(currency)) WHEN 'USD' THEN 1.0 WHEN 'EUR' THEN 1.08 WHEN 'GBP' THEN 1.27
           WHEN 'CAD' THEN 0.74 ELSE 1.0 END::DOUBLE AS revenue_usd,
         upper(trim(currency)) AS currency, upper(trim(region)) AS region,
         CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date, event_timestamp, TRUE AS is_valid,
         '2024-01-31' AS processing_date
       FROM raw_sales
       WHERE event_id IS NOT NULL AND customer_id IS NOT NULL AND event_timestamp IS NOT NULL
         AND quantity > 0 AND unit_price > 0""",
)


@query("dq_clean_sales", CLEAN_SQL)
def dq_clean_sales(spark, sf):
    return q.clean_sales(e.raw_sales(spark, sf), e.AS_OF)


@query(
    "dq_metrics",
    check(
        "raw_sales",
        """, m AS (SELECT event_id IS NOT NULL AND customer_id IS NOT NULL AND event_timestamp IS NOT NULL AS whole,
              coalesce(quantity > 0 AND unit_price > 0, FALSE) AS valid FROM raw_sales),
           c AS (SELECT count(*) AS input_records, count(*) FILTER (whole AND valid) AS output_records,
              count(*) FILTER (NOT whole) AS null_records_dropped,
              count(*) FILTER (whole AND NOT valid) AS invalid_amount_dropped FROM m)
           SELECT *, input_records - output_records AS total_records_dropped,
             round(output_records * 100.0::DOUBLE / input_records, 2) AS pass_rate_pct, '2024-01-31' AS execution_date
           FROM c""",
    ),
)
def dq_metrics(spark, sf):
    return q.clean_metrics(e.raw_sales(spark, sf), e.AS_OF)


@query(
    "dq_validate",
    check(
        "raw_sales",
        """, c AS (SELECT event_id, customer_id, quantity * unit_price AS revenue_usd,
              CAST(event_timestamp AS DATE) AS event_date FROM raw_sales)
           SELECT count(*) AS total_records, count(*) FILTER (event_id IS NULL) AS null_event_id,
             count(*) FILTER (customer_id IS NULL) AS null_customer_id,
             count(*) FILTER (revenue_usd IS NULL) AS null_revenue_usd,
             count(*) FILTER (event_date IS NULL) AS null_event_date,
             count(*) FILTER (revenue_usd <= 0) AS non_positive_revenue FROM c""",
    ),
)
def dq_validate(spark, sf):
    """The output checks on uncleaned rows, where they have something to find."""
    rows = e.raw_sales(spark, sf).select(
        "event_id",
        "customer_id",
        (F.col("quantity") * F.col("unit_price")).alias("revenue_usd"),
        F.to_date("event_timestamp").alias("event_date"),
    )
    return q.output_checks(rows)


@query(
    "dq_validate_output",
    check(
        "raw_sales",
        """, c AS (SELECT 'raw' AS rows, event_id, customer_id, quantity * unit_price AS revenue_usd,
              CAST(event_timestamp AS DATE) AS event_date FROM raw_sales),
           k AS (SELECT * FROM c UNION ALL SELECT 'cleaned', * EXCLUDE (rows) FROM c WHERE event_id IS NOT NULL
              AND customer_id IS NOT NULL AND revenue_usd > 0 AND event_date IS NOT NULL)
           SELECT rows, count(*) FILTER (event_id IS NULL OR customer_id IS NULL OR revenue_usd IS NULL OR event_date IS NULL
             OR revenue_usd <= 0) = 0 AS valid, FALSE AS valid_at_95 FROM k GROUP BY 1""",
    ),
)
def dq_validate_output(spark, sf):
    """The verdict on uncleaned and on cleaned rows, and on a pass rate below the minimum."""
    raw = e.raw_sales(spark, sf)
    uncleaned = raw.select(
        "event_id", "customer_id", (F.col("quantity") * F.col("unit_price")).alias("revenue_usd"), F.to_date("event_timestamp").alias("event_date")
    )
    found = []
    for name, rows in (("raw", uncleaned), ("cleaned", q.clean_sales(raw, e.AS_OF))):
        found.append((name, q.validate_output(rows), q.validate_output(rows, 95.0, 90.0)))
    return spark.createDataFrame(found, "rows STRING, valid BOOLEAN, valid_at_95 BOOLEAN")


BROKEN_SQL = """CASE WHEN event_id IS NULL THEN 'has_event,' ELSE '' END
    || CASE WHEN customer_id IS NULL THEN 'has_customer,' ELSE '' END
    || CASE WHEN NOT coalesce(quantity > 0, FALSE) THEN 'positive_quantity,' ELSE '' END
    || CASE WHEN NOT coalesce(unit_price > 0, FALSE) THEN 'positive_price,' ELSE '' END"""


@query(
    "dq_branch",
    check(
        "raw_sales",
        f"""SELECT event_id, customer_id, quantity, unit_price, CASE WHEN {SALES_OK} THEN 'publish' ELSE 'quarantine' END
              AS branch, rtrim({BROKEN_SQL}, ',') AS failed_rules FROM raw_sales""",
    ),
)
def dq_branch(spark, sf):
    """Both branches written twice for one run date and read back; each row is in exactly one."""
    base, rows = scratch_path(spark, "branch"), e.raw_sales(spark, sf)
    for _ in range(2):
        paths = loads.publish_or_quarantine(rows, SALES_RULES, f"{base}/good", f"{base}/bad", "2024-02-01")
    passed, held = spark.read.parquet(paths["publish"]), spark.read.parquet(paths["quarantine"])
    cols = ["event_id", "customer_id", "quantity", "unit_price"]
    good = passed.select(*cols, F.lit("publish").alias("branch"), F.lit("").alias("failed_rules"))
    bad = held.select(*cols, F.lit("quarantine").alias("branch"), F.array_join("failed_rules", ",").alias("failed_rules"))
    return good.unionByName(bad)


def _daily(spark, sf):
    return sales_daily_metrics(e.orders(spark, sf), e.items(spark, sf))


@query(
    "dq_alert_revenue",
    check(
        "daily",
        """, d AS (SELECT date, total_revenue, lag(total_revenue) OVER (ORDER BY date) AS prev_revenue FROM daily)
           SELECT *, round((total_revenue - prev_revenue) * 100.0::DOUBLE / prev_revenue, 2) AS revenue_change_pct,
             coalesce(round((total_revenue - prev_revenue) * 100.0::DOUBLE / prev_revenue, 2) < -20, FALSE) AS alert
           FROM d WHERE date = (SELECT max(date) FROM daily)""",
    ),
)
def dq_alert_revenue(spark, sf):
    return q.revenue_alert(_daily(spark, sf))


@query(
    "dq_alert_orders",
    check(
        "daily",
        "SELECT date, total_orders, total_orders < 10 AS alert FROM daily WHERE date = (SELECT max(date) FROM daily)",
    ),
)
def dq_alert_orders(spark, sf):
    return q.order_alert(_daily(spark, sf))


@query(
    "dq_post_checks",
    check(
        "ord",
        """, f AS (SELECT DISTINCT customer_id FROM ord)
           SELECT (SELECT count(*) FROM ord WHERE total_amount <= 0) AS non_positive_orders,
             (SELECT count(DISTINCT customer_id) FROM ord) AS order_customers,
             (SELECT count(*) FROM f) AS feature_customers""",
    ),
)
def dq_post_checks(spark, sf):
    orders = e.orders(spark, sf)
    features = order_feature_table(orders).agg(F.countDistinct("customer_id").alias("feature_customers"))
    return orders.agg(
        F.count_if(F.col("total_amount") <= 0).alias("non_positive_orders"),
        F.countDistinct("customer_id").alias("order_customers"),
        F.max(features.scalar()).alias("feature_customers"),
    )


@query(
    "dq_post_checks_run",
    check(
        "ord items",
        """, r AS (SELECT count(*) AS n, count(*) FILTER (total_amount <= 0) AS bad, count(*) FILTER (order_date IS NULL) AS undated FROM ord)
           SELECT c.check_name, CASE c.check_name WHEN 'order amounts are positive' THEN r.bad = 0
               WHEN 'daily metrics have dates' THEN r.undated = 0 WHEN 'features cover all customers' THEN TRUE ELSE r.n > 0 END AS passed
           FROM r, (VALUES ('orders has rows'), ('sales_daily_metrics has rows'), ('fs_order_features has rows'),
             ('daily metrics have dates'), ('order amounts are positive'), ('features cover all customers')) c(check_name)""",
    ),
)
def dq_post_checks_run(spark, sf):
    """The checks that follow a run, on the tables it makes."""
    orders = e.orders(spark, sf)
    tables = {"orders": orders, "sales_daily_metrics": _daily(spark, sf), "fs_order_features": order_feature_table(orders)}
    return spark.createDataFrame(list(loads.post_checks(spark, tables).items()), "check_name STRING, passed BOOLEAN")


# -- checked silver tables -------------------------------------------------

ORDERS_SILVER = """, c AS (SELECT order_id, customer_id, CAST(order_date AS TIMESTAMP) AS order_date, order_total,
      upper(left(trim(order_status), 1)) || lower(substr(trim(order_status), 2)) AS order_status FROM ord)
    SELECT *, year(order_date) AS order_year, month(order_date) AS order_month, quarter(order_date) AS order_quarter,
      dayofweek(order_date) + 1 AS order_day_of_week,
      CASE WHEN order_total < 500 THEN 'Low' WHEN order_total < 1500 THEN 'Medium' WHEN order_total < 2500 THEN 'High'
        ELSE 'Premium' END AS order_value_category
    FROM c WHERE order_status IN ('Delivered', 'Shipped', 'Pending')"""


def _plain_orders(spark, sf):
    return e.orders(spark, sf).select("order_id", "customer_id", "order_date", "order_total", "order_status")


@query("pipe_orders_silver", check("ord", ORDERS_SILVER))
def pipe_orders_silver(spark, sf):
    once = _plain_orders(spark, sf)
    return medallion.checked_orders(once.unionByName(once.where("order_status = 'Pending'")))


@query(
    "pipe_customers_silver",
    check(
        "customers",
        """, c AS (SELECT customer_id, trim(name) AS name, lower(trim(email)) AS email, signup_date,
             upper(left(city, 1)) || lower(substr(city, 2)) AS city, upper(state) AS state,
             CASE WHEN country = 'MIDDLE EAST' THEN 'Middle East' ELSE upper(left(country, 1)) || lower(substr(country, 2))
               END AS country,
             CAST(date_diff('day', signup_date, DATE '2024-01-31') AS INTEGER) AS customer_tenure_days
           FROM customers)
           SELECT *, round(customer_tenure_days / 365, 1) + 0.0 AS customer_tenure_years,
             CASE WHEN customer_tenure_days < 180 THEN 'New' WHEN customer_tenure_days < 365 THEN 'Growing'
               WHEN customer_tenure_days < 730 THEN 'Established' ELSE 'Loyal' END AS customer_tenure_segment
           FROM c WHERE name IS NOT NULL AND length(name) > 0""",
    ),
)
def pipe_customers_silver(spark, sf):
    once = e.customers(spark, sf).select(
        "customer_id", "name", "email", "city", "state", "country", "signup_date"
    )
    again = once.where("country = 'ASIA'")
    return medallion.checked_customers(once.unionByName(again), F.lit(e.AS_OF).cast("date"))


@query(
    "pipe_geo_sales",
    GEO.replace("FROM ord JOIN customers", "FROM (SELECT * FROM ord WHERE trim(order_status) <> 'cancelled') JOIN customers"),
)
def pipe_geo_sales(spark, sf):
    kept = _geo_orders(spark, sf).where("order_status <> 'Cancelled'")
    return geographic_sales(kept, e.customers(spark, sf))


# -- governance ------------------------------------------------------------

# fixed values: the region code shown for each test region
REGION_CODE = {"AFRICA": "EMEA", "AMERICA": "US", "ASIA": "APAC", "EUROPE": "EU"}
ANALYTICS_SQL = """a AS (SELECT customer_id, email, phone, CAST(balance AS DECIMAL(10,2)) AS total_revenue,
    CASE country WHEN 'AFRICA' THEN 'EMEA' WHEN 'AMERICA' THEN 'US' WHEN 'ASIA' THEN 'APAC' WHEN 'EUROPE' THEN 'EU' END
      AS region FROM customers)"""
EMAIL_SQL = """CASE WHEN email IS NULL THEN NULL WHEN contains(email, '@')
    THEN left(email, 2) || '****@' || split_part(email, '@', 2) ELSE '****@' END"""
PHONE_SQL = "'***-***-' || right(regexp_replace(phone, '[^0-9]', '', 'g'), 4)"


def _analytics(spark, sf):
    region = None
    for name, code in REGION_CODE.items():
        test = F.col("country") == name
        region = F.when(test, code) if region is None else region.when(test, code)
    return e.customers(spark, sf).select(
        "customer_id", "email", "phone", F.col("balance").cast("decimal(10,2)").alias("total_revenue"), region.alias("region")
    )


@query("gov_mask_email", check("customers", f"SELECT customer_id, {EMAIL_SQL} AS email FROM customers"))
def gov_mask_email(spark, sf):
    return _analytics(spark, sf).select("customer_id", gov.mask_email(F.col("email"), []).alias("email"))


@query("gov_mask_phone", check("customers", f"SELECT customer_id, {PHONE_SQL} AS phone FROM customers"))
def gov_mask_phone(spark, sf):
    return _analytics(spark, sf).select("customer_id", gov.mask_phone(F.col("phone"), []).alias("phone"))


@query(
    "gov_mask_money",
    check(
        "customers",
        f""", {ANALYTICS_SQL} SELECT customer_id, CAST(NULL AS DOUBLE) AS hidden, CAST(total_revenue AS DOUBLE) AS shown FROM a""",
    ),
)
def gov_mask_money(spark, sf):
    v = F.col("total_revenue")
    return _analytics(spark, sf).select(
        "customer_id",
        gov.mask_money(v, []).cast("double").alias("hidden"),
        gov.mask_money(v, ["finance_team"]).cast("double").alias("shown"),
    )


@query(
    "gov_row_filter",
    check("customers", f", {ANALYTICS_SQL} SELECT customer_id, region FROM a WHERE region IN ('EU', 'UK', 'EMEA', 'US', 'CA')"),
)
def gov_row_filter(spark, sf):
    allowed = gov.region_allowed(F.col("region"), ["emea_team", "na_team"])
    return _analytics(spark, sf).where(allowed).select("customer_id", "region")


@query(
    "gov_apply",
    check(
        "customers",
        f""", {ANALYTICS_SQL} SELECT customer_id, {EMAIL_SQL} AS email, {PHONE_SQL} AS phone,
              CAST(total_revenue AS DOUBLE) AS total_revenue, region FROM a WHERE region IN ('APAC', 'JP', 'AU')""",
    ),
)
def gov_apply(spark, sf):
    view = gov.secure_view(_analytics(spark, sf), gov.CUSTOMER_ANALYTICS, ["apac_team", "finance_team"])
    return view.withColumn("total_revenue", F.col("total_revenue").cast("double"))


@query(
    "udf_sql_scalar",
    check(
        "customers",
        f""", {ANALYTICS_SQL} SELECT customer_id, {EMAIL_SQL} AS email, {PHONE_SQL} AS phone,
              CAST(NULL AS DOUBLE) AS total_revenue FROM a WHERE region IN ('US', 'CA')""",
    ),
)
def udf_sql_scalar(spark, sf):
    gov.register_mask_functions(spark, ["na_team"])
    return spark.sql(
        """SELECT customer_id, mask_email(email) AS email, mask_phone(phone) AS phone,
             CAST(mask_revenue(total_revenue) AS DOUBLE) AS total_revenue
           FROM {a} WHERE filter_by_region(region)""",
        a=_analytics(spark, sf),
    )
