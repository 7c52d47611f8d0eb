"""Registered queries: one per scalar function, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.functions.scalars import usd_rate
from stratalake.plans import medallion
from stratalake.queries import entities as e
from stratalake.queries.entities import check
from stratalake.queries.registry import query


def _over(name: str, table: str, keys: list[str], spark_columns, sql_columns: str) -> None:
    """A projection of a test table: `spark_columns` builds the columns inside a session."""
    sql = f"SELECT {', '.join(keys)}, {sql_columns} FROM {table}"
    query(name, sql)(lambda spark, sf: e.load(spark, sf, table).select(*keys, *spark_columns()))


def _ts(c: str) -> Column:
    return F.col(c).cast("timestamp")


PADDED = "'  ' || c_name || ' '"


def _padded() -> Column:
    return F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))


_over("fn_trim", "customer", ["c_custkey"], lambda: [F.trim(_padded()).alias("v")], f"trim({PADDED}) AS v")
_over("fn_lower", "customer", ["c_custkey"], lambda: [F.lower("c_name").alias("v")], "lower(c_name) AS v")
_over("fn_upper", "customer", ["c_custkey"], lambda: [F.upper("c_name").alias("v")], "upper(c_name) AS v")
_over(
    "fn_initcap",
    "customer",
    ["c_custkey"],
    lambda: [F.initcap("c_mktsegment").alias("v")],
    "upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS v",
)
_over(
    "fn_concat",
    "orders",
    ["o_orderkey"],
    lambda: [F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string"), F.lit("/"), "o_orderstatus").alias("v")],
    "'ORD-' || o_orderkey || '/' || o_orderstatus AS v",
)
_over("fn_length", "documents", ["doc_id"], lambda: [F.length("text").alias("v")], "length(text) AS v")
_over(
    "fn_left_right",
    "part",
    ["p_partkey"],
    lambda: [F.left("p_name", F.lit(2)).alias("head"), F.right("p_name", F.lit(4)).alias("tail")],
    "left(p_name, 2) AS head, right(p_name, 4) AS tail",
)
_over(
    "fn_split_index",
    "part",
    ["p_partkey"],
    lambda: [F.get(F.split("p_name", " "), 1).alias("second"), F.get(F.split("p_name", " "), 9).alias("tenth")],
    "string_split(p_name, ' ')[2] AS second, string_split(p_name, ' ')[10] AS tenth",
)
_over(
    "fn_regexp_replace",
    "customer",
    ["c_custkey"],
    lambda: [F.regexp_replace("c_name", "[^0-9]", "").alias("digits")],
    "regexp_replace(c_name, '[^0-9]', '', 'g') AS digits",
)
_over("fn_like", "part", ["p_partkey"], lambda: [F.col("p_name").like("%bolt%").alias("v")], "p_name LIKE '%bolt%' AS v")
_over(
    "fn_to_date",
    "orders",
    ["o_orderkey"],
    lambda: [
        F.to_date(F.date_format("o_orderdate", "yyyy-MM-dd"), "yyyy-MM-dd").alias("d"),
        F.try_to_date("o_orderpriority").alias("bad"),
    ],
    "CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS d, TRY_CAST(o_orderpriority AS DATE) AS bad",
)
_over(
    "fn_to_timestamp",
    "events",
    ["event_id"],
    lambda: [
        F.try_to_timestamp(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).alias("t"),
        F.try_to_timestamp("event_type").alias("bad"),
    ],
    "date_trunc('millisecond', ts) AS t, TRY_CAST(event_type AS TIMESTAMP) AS bad",
)
_over(
    "fn_year_month_day",
    "orders",
    ["o_orderkey"],
    lambda: [F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), F.day("o_orderdate").alias("d")],
    "year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d",
)
_over("fn_quarter", "orders", ["o_orderkey"], lambda: [F.quarter("o_orderdate").alias("v")], "quarter(o_orderdate) AS v")
_over("fn_weekofyear", "orders", ["o_orderkey"], lambda: [F.weekofyear("o_orderdate").alias("v")], "weekofyear(o_orderdate) AS v")
_over("fn_dayofweek", "orders", ["o_orderkey"], lambda: [F.dayofweek("o_orderdate").alias("v")], "dayofweek(o_orderdate) + 1 AS v")
_over(
    "fn_date_format_eeee",
    "orders",
    ["o_orderkey"],
    lambda: [F.date_format("o_orderdate", "EEEE").alias("v")],
    "dayname(o_orderdate) AS v",
)
_over(
    "fn_datediff",
    "lineitem",
    ["l_orderkey", "l_linenumber"],
    lambda: [F.datediff(F.lit("2002-01-01").cast("date"), F.col("l_shipdate")).alias("v")],
    "date_diff('day', CAST(l_shipdate AS DATE), DATE '2002-01-01') AS v",
)
_over(
    "fn_current_date_current_timestamp",
    "orders",
    ["o_orderkey"],
    lambda: [
        (F.col("o_orderdate").cast("date") <= F.current_date()).alias("past_day"),
        (_ts("o_orderdate") <= F.current_timestamp()).alias("past_time"),
    ],
    "CAST(o_orderdate AS DATE) <= current_date AS past_day, o_orderdate <= CAST(now() AS TIMESTAMP) AS past_time",
)
_over("fn_date_ts", "events", ["event_id"], lambda: [F.to_date("ts").alias("v")], "CAST(ts AS DATE) AS v")
_over(
    "fn_date_trunc",
    "events",
    ["event_id"],
    lambda: [
        F.date_trunc("month", "ts").cast("date").alias("m"),
        F.date_trunc("week", "ts").cast("date").alias("w"),
        F.date_trunc("hour", "ts").cast("timestamp").alias("h"),
    ],
    "CAST(date_trunc('month', ts) AS DATE) AS m, CAST(date_trunc('week', ts) AS DATE) AS w, date_trunc('hour', ts) AS h",
)
_over(
    "fn_dateadd",
    "orders",
    ["o_orderkey"],
    lambda: [F.dateadd("o_orderdate", -30).alias("v")],
    "CAST(o_orderdate AS DATE) - 30 AS v",
)
_over(
    "fn_timestampdiff",
    "events",
    ["event_id"],
    lambda: [F.timestamp_diff("SECOND", F.lit("2024-01-01").cast("timestamp"), _ts("ts")).alias("v")],
    "CAST(floor(epoch(ts) - epoch(TIMESTAMP '2024-01-01')) AS BIGINT) AS v",
)
_over(
    "fn_unix_timestamp_difference",
    "events",
    ["event_id"],
    lambda: [(F.unix_timestamp(_ts("ts")) - F.unix_timestamp(F.lit("2024-01-01").cast("timestamp"))).alias("v")],
    "CAST(floor(epoch(ts)) - epoch(TIMESTAMP '2024-01-01') AS BIGINT) AS v",
)
_over(
    "fn_interval_literal",
    "events",
    ["event_id"],
    lambda: [(_ts("ts") - F.expr("INTERVAL 3 DAYS")).alias("a"), (_ts("ts") + F.expr("INTERVAL 90 MINUTES")).alias("b")],
    "ts - INTERVAL 3 DAY AS a, ts + INTERVAL 90 MINUTE AS b",
)
_over(
    "fn_epoch_to_timestamp_cast",
    "events",
    ["event_id"],
    lambda: [(F.lit(1640995200) + F.col("event_id") * 60).cast("timestamp").alias("v")],
    "TIMESTAMP '2022-01-01' + to_minutes(event_id) AS v",
)
_over(
    "fn_window_ts_size",
    "events",
    ["event_id"],
    lambda: [
        F.window(_ts("ts"), "5 minutes").start.alias("five_start"),
        F.window(_ts("ts"), "5 minutes").end.alias("five_end"),
    ],
    """time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') AS five_start,
       time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') + INTERVAL 5 MINUTE AS five_end""",
)
_over(
    "fn_round",
    "lineitem",
    ["l_orderkey", "l_linenumber"],
    lambda: [F.round("l_extendedprice", 0).alias("whole"), F.round(F.col("l_quantity") / 7, 3).alias("sevenths")],
    "round(l_extendedprice, 0) AS whole, round(l_quantity / 7, 3) AS sevenths",
)


@query(
    "fn_rand",
    "SELECT count(*) AS n_rows, TRUE AS in_range, TRUE AS even_mean, CAST(10 AS BIGINT) AS buckets FROM events",
)
def fn_rand(spark, sf):
    """Random numbers for every row, and what can be said of all of them."""
    drawn = e.load(spark, sf, "events").select("event_id", F.rand(7).alias("u"), (F.rand(8) * 10).cast("int").alias("bucket"))
    return drawn.agg(
        F.count("event_id").alias("n_rows"),
        F.bool_and(F.col("u").between(0, 1) & (F.col("u") < 1)).alias("in_range"),
        F.avg("u").between(0.4, 0.6).alias("even_mean"),
        F.countDistinct("bucket").alias("buckets"),
    )


_over(
    "fn_case_when",
    "orders",
    ["o_orderkey"],
    lambda: [F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "O", 1).otherwise(0).alias("v")],
    "CASE WHEN o_orderstatus = 'F' THEN 2 WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS v",
)
_over(
    "fn_coalesce",
    "events",
    ["event_id"],
    lambda: [F.coalesce(F.when(F.col("event_id") % 3 == 0, F.col("value")), F.lit(1.0)).alias("v")],
    "coalesce(CASE WHEN event_id % 3 = 0 THEN value END, 1.0) AS v",
)
_over(
    "fn_is_null_is_not_null",
    "events",
    ["event_id"],
    lambda: [
        F.when(F.col("event_id") % 3 == 0, F.col("value")).isNull().alias("a"),
        F.when(F.col("event_id") % 3 == 0, F.col("value")).isNotNull().alias("b"),
    ],
    "CASE WHEN event_id % 3 = 0 THEN value END IS NULL AS a, CASE WHEN event_id % 3 = 0 THEN value END IS NOT NULL AS b",
)
_over(
    "fn_in_isin",
    "part",
    ["p_partkey"],
    lambda: [F.col("p_type").isin("ECONOMY", "PROMO").alias("v")],
    "p_type IN ('ECONOMY', 'PROMO') AS v",
)
_over(
    "fn_array",
    "part",
    ["p_partkey"],
    lambda: [F.array_join(F.array("p_brand", "p_type", F.lit("x")), "|").alias("v")],
    "array_to_string([p_brand, p_type, 'x'], '|') AS v",
)
_over(
    "fn_element_at",
    "events",
    ["event_id"],
    lambda: [
        F.element_at(F.array(*[F.lit(r) for r in ("US", "EU", "APAC")]), (F.col("event_id") % 3 + 1).cast("int")).alias("v")
    ],
    "(['US', 'EU', 'APAC'])[CAST(event_id % 3 + 1 AS INTEGER)] AS v",
)
_over(
    "fn_explode",
    "part",
    ["p_partkey"],
    lambda: [F.explode(F.split("p_name", " ")).alias("word")],
    "unnest(string_split(p_name, ' ')) AS word",
)
_over(
    "fn_sequence_by_day",
    "supplier",
    ["s_suppkey"],
    lambda: [
        F.explode(
            F.sequence(
                F.lit("2024-02-26").cast("date"),
                F.date_add(F.lit("2024-02-26").cast("date"), (F.col("s_suppkey") % 5).cast("int")),
                F.expr("INTERVAL 1 DAY"),
            )
        ).alias("day")
    ],
    """CAST(unnest(generate_series(TIMESTAMP '2024-02-26', TIMESTAMP '2024-02-26' + to_days(CAST(s_suppkey % 5 AS INTEGER)),
       INTERVAL 1 DAY)) AS DATE) AS day""",
)
_over(
    "fn_create_map_lookup",
    "orders",
    ["o_orderkey"],
    lambda: [usd_rate("o_orderstatus", {"F": 1.08, "O": 1.27}).alias("rate")],
    "CASE o_orderstatus WHEN 'F' THEN 1.08 WHEN 'O' THEN 1.27 ELSE 1.0 END::DOUBLE AS rate",
)
_over(
    "fn_from_json",
    "events",
    ["event_id"],
    lambda: [F.from_json("props", "k INT").getField("k").alias("k")],
    "CAST(json_extract(props, '$.k') AS INTEGER) AS k",
)


@query("fn_field_access", "SELECT c_custkey, c_name AS name, n_name AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey")
def fn_field_access(spark, sf):
    c, n = e.load(spark, sf, "customer"), e.load(spark, sf, "nation")
    joined = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    nested = joined.select(
        "c_custkey", F.struct(F.col("c_name").alias("name"), F.struct(F.col("n_name").alias("nation")).alias("place")).alias("who")
    )
    return nested.select("c_custkey", "who.name", "who.place.nation")


_over(
    "fn_cast",
    "lineitem",
    ["l_orderkey", "l_linenumber"],
    lambda: [
        F.col("l_quantity").cast("int").alias("i"),
        F.col("l_shipdate").cast("date").alias("d"),
        F.col("l_returnflag").try_cast("double").alias("bad"),
    ],
    "CAST(l_quantity AS INTEGER) AS i, CAST(l_shipdate AS DATE) AS d, TRY_CAST(l_returnflag AS DOUBLE) AS bad",
)
_over(
    "fn_lit",
    "region",
    ["r_regionkey"],
    lambda: [F.lit("x").alias("s"), F.lit(3).alias("i"), F.lit(True).alias("b")],
    "'x' AS s, 3 AS i, TRUE AS b",
)
_over(
    "fn_not_equal",
    "orders",
    ["o_orderkey"],
    lambda: [(F.col("o_orderstatus") != "F").alias("v")],
    "o_orderstatus <> 'F' AS v",
)

# -- composite builders ----------------------------------------------------

CALENDAR_SQL = """year(date_value) AS year, month(date_value) AS month, day(date_value) AS day,
    quarter(date_value) AS quarter, weekofyear(date_value) AS week_of_year, dayname(date_value) AS day_of_week_name,
    dayofweek(date_value) + 1 AS day_of_week_num,
    CASE WHEN dayofweek(date_value) IN (6, 0) THEN 1 ELSE 0 END AS is_weekend"""


@query(
    "dim_date",
    f"""WITH span AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
        dates AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
                    AS date_value FROM span)
        SELECT row_number() OVER (ORDER BY date_value) AS date_sk, date_value, {CALENDAR_SQL} FROM dates""",
)
def dim_date(spark, sf):
    """The calendar over the dates of the orders."""
    span = e.load(spark, sf, "orders").agg(
        F.min("o_orderdate").cast("date").cast("string").alias("lo"),
        F.max("o_orderdate").cast("date").cast("string").alias("hi"),
    ).first()
    return medallion.dim_date(spark, span["lo"], span["hi"])


RATE_SQL = "CASE upper(trim(currency)) WHEN 'USD' THEN 1.0 WHEN 'EUR' THEN 1.08 WHEN 'GBP' THEN 1.27 WHEN 'CAD' THEN 0.74 ELSE 1.0 END::DOUBLE"


@query(
    "revenue_usd",
    check("raw_sales", f"SELECT event_id, currency, quantity * unit_price * {RATE_SQL} AS revenue_usd FROM raw_sales"),
)
def revenue_usd(spark, sf):
    rate = usd_rate(F.upper(F.trim("currency")))
    return e.raw_sales(spark, sf).select(
        "event_id", "currency", (F.col("quantity") * F.col("unit_price") * rate).alias("revenue_usd")
    )
