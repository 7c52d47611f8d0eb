import random
from datetime import datetime

import pytest
from support_core import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake.operators import joins, skew
from stratalake.operators.dedup import drop_duplicate_keys, latest_per_key, newest_batch


def sides(spark, keys, dims=30):
    fact = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "customer_id INT, amount INT").repartition(4)
    dim = spark.createDataFrame([(k, f"Customer {k}") for k in range(1, dims + 1)], "customer_id INT, customer_name STRING")
    return fact, dim


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(1, 35)), min_size=1, max_size=80), st.integers(1, 20))
def test_salted_joins_equal_the_plain_join(spark, keys, more_than):
    fact, dim = sides(spark, keys + [1] * 40)
    inner = rows(fact.join(dim, "customer_id"))
    for salts in (None, 4):
        salted = joins.join_salted_selective(fact, dim, "customer_id", more_than, salts)
        assert rows(salted.select("customer_id", "amount", "customer_name")) == inner
    left = rows(fact.join(dim, "customer_id", "left"))
    assert rows(joins.join_salted_full(fact, dim, "customer_id", 3).select("customer_id", "amount", "customer_name")) == left


def test_salting_keeps_the_keys_that_are_not_hot(spark):
    fact, dim = sides(spark, [1] * 900 + list(range(2, 31)) * 3)
    got = joins.join_salted_selective(fact, dim, "customer_id", 100).groupBy("customer_id").count()
    assert rows(got) == sorted([(1, 900)] + [(k, 3) for k in range(2, 31)], key=repr)


def test_a_hotter_key_gets_more_salts(spark):
    fact, dim = sides(spark, [1] * 4000 + [2] * 1500 + list(range(3, 31)))
    joined = joins.join_salted_selective(fact, dim, "customer_id")
    assert joined.count() == 5528
    text = plan(joined, "simple")
    assert "sequence" in text and "BroadcastHashJoin" in text


def test_salts_spread_identical_rows(spark):
    df = spark.range(4000).select(F.lit(1).alias("k")).repartition(16)
    assert df.select(joins.salt_of(df, 8).alias("s")).distinct().count() > 4


def test_checked_broadcast(spark):
    fact, dim = sides(spark, [1, 2, 3])
    assert joins.fits_broadcast(dim)
    assert not joins.fits_broadcast(dim, max_rows=10)
    assert not joins.fits_broadcast(dim, max_bytes=100)
    assert "BroadcastHashJoin" in plan(joins.join_small(fact, dim, "customer_id"))


PRICES = [
    ("A", datetime(2024, 1, 1), datetime(2024, 1, 10), 1.0),
    ("A", datetime(2024, 1, 10), None, 2.0),
    ("B", datetime(2024, 1, 5), datetime(2024, 2, 1), 3.0),
]


def test_overlapping_prices_are_found(spark):
    bad = PRICES + [("B", datetime(2024, 1, 20), datetime(2024, 3, 1), 4.0)]
    prices = spark.createDataFrame(bad, "sku STRING, start_at TIMESTAMP, end_at TIMESTAMP, price DOUBLE")
    assert [r["price"] for r in joins.overlapping_validity(prices, ["sku"], "start_at", "end_at").collect()] == [4.0]


def test_latest_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 50 + [2, 3])], "k INT, v INT")
    latest = latest_per_key(df, ["k"], [F.desc("v")])
    assert rows(latest) == [(1, 49), (2, 50), (3, 51)]
    text = plan(latest, "simple")
    assert "WindowGroupLimit" in text and text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_newest_batch_keeps_ties_and_null_loads(spark):
    data = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "u"), ("b", None, "v"), (None, 1, "n")]
    df = spark.createDataFrame(data, "k STRING, loaded INT, v STRING")
    assert [r["v"] for r in newest_batch(df, ["k"], "loaded").orderBy("v").collect()] == ["n", "u", "v", "y", "z"]


def test_drop_duplicate_keys_is_repeatable(spark):
    data = [(k, v) for k in range(5) for v in random.Random(k).sample(range(100), 20)]
    a = drop_duplicate_keys(spark.createDataFrame(data, "k INT, v INT").repartition(7), ["k"])
    b = drop_duplicate_keys(spark.createDataFrame(data[::-1], "k INT, v INT").repartition(3), ["k"])
    assert rows(a) == rows(b) and a.count() == 5


def test_skew_report(spark):
    fact, _ = sides(spark, [1] * 900 + list(range(2, 102)))
    got = skew.skew_report(fact, "customer_id").first()
    assert got["max_count"] == 900 and got["p95_count"] == 1 and got["is_skewed"]
    assert rows(skew.top_keys(fact, "customer_id", 2), F.desc("order_count"), "customer_id") == [(1, 900), (2, 1)]
    empty = skew.skew_report(fact.where("FALSE"), "customer_id").first()
    assert empty["skew_ratio"] == 0.0 and not empty["is_skewed"]


def test_open_prices_reach_as_far_as_the_usage(spark):
    from stratalake.plans.monitoring import cost_at_list_price

    usage = spark.createDataFrame(
        [("c", "s", "w", "p", datetime(2024, m, 5), datetime(2024, m, 6), 1.0) for m in (1, 2, 3)],
        "cloud STRING, sku_name STRING, workspace_id STRING, billing_origin_product STRING, usage_start_time TIMESTAMP, usage_end_time TIMESTAMP, usage_quantity DOUBLE",
    )
    prices = spark.createDataFrame(
        [("c", "s", datetime(2023, 12, 1), None, (2.0,))],
        "cloud STRING, sku_name STRING, price_start_time TIMESTAMP, price_end_time TIMESTAMP, pricing STRUCT<default: DOUBLE>",
    )
    assert [r["list_cost"] for r in cost_at_list_price(usage, prices).collect()] == [6.0]


def test_full_salting_copies_only_what_hot_keys_need(spark):
    fact = spark.range(40_000).select(F.when(F.col("id") < 30_000, 1).otherwise(F.col("id") % 500 + 2).alias("k"), F.col("id").alias("v"))
    fact = fact.unionByName(spark.createDataFrame([(None, -1)], "k LONG, v LONG"))
    dim = spark.range(1, 400).select(F.col("id").alias("k"), (F.col("id") * 10).alias("d"))
    for how in ("left", "inner"):
        want = fact.join(dim, "k", how)
        got = joins.join_salted_full(fact, dim, "k", how=how)
        assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    fixed = joins.join_salted_full(fact, dim, "k", salts=3)
    assert fixed.count() == fact.count()


def test_overlaps_of_a_split_product(spark):
    import datetime as dt
    import random

    rng, day = random.Random(3), dt.datetime(2024, 1, 1)
    starts = rng.sample(range(4000), 400)
    data = [("hot" if i % 5 else f"p{i % 4}", day + dt.timedelta(hours=s), rng.choice([None] + [day + dt.timedelta(hours=s + rng.randrange(1, 40))] * 400), i) for i, s in enumerate(starts)]
    prices = spark.createDataFrame(data, "p STRING, a TIMESTAMP, b TIMESTAMP, i INT")
    want = set()
    for p in {d[0] for d in data}:
        reach = None
        for row in sorted((d for d in data if d[0] == p), key=lambda d: d[1]):
            if reach is not None and row[1] < reach:
                want.add(row[3])
            reach = max(reach or day, row[2] or dt.datetime.max)
    for hot_rows in (5_000_000, 20):
        found = joins.overlapping_validity(prices, ["p"], "a", "b", hot_rows)
        assert found.columns == prices.columns and {r.i for r in found.collect()} == want and found.count() == len(want)
