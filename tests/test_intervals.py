import random
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from support_core import rows

from stratalake.operators import intervals

PRICES = [
    ("A", datetime(2024, 1, 1), datetime(2024, 1, 10), 1.0),
    ("A", datetime(2024, 1, 10), None, 2.0),
    ("B", datetime(2024, 1, 5), datetime(2024, 2, 1), 3.0),
    ("B", datetime(2024, 2, 3), datetime(2024, 1, 2), 4.0),  # ends before it begins
    ("C", None, None, 5.0),
    (None, datetime(2024, 1, 1), None, 6.0),
]
USAGE = [("A", d, datetime(d.year, d.month, d.day, 12)) for d in map(lambda n: datetime(2024, 1, n), (1, 9, 10, 11))]
USAGE += [("B", datetime(2024, 1, 4), datetime(2024, 1, 4, 12)), ("B", datetime(2024, 1, 31), datetime(2024, 2, 1)),
          ("B", datetime(2024, 1, 31, 1), datetime(2024, 2, 1, 1)), ("A", datetime(2024, 5, 1), datetime(2024, 5, 2)),
          ("B", datetime(2024, 2, 5), datetime(2024, 1, 1)), ("B", datetime(2024, 1, 9), datetime(2024, 1, 1)),
          ("A", datetime(2024, 1, 5), None), ("A", datetime(2024, 1, 12), None), ("C", datetime(2024, 1, 1), None),
          (None, datetime(2024, 1, 5), datetime(2024, 1, 5))]


@pytest.mark.parametrize("bin_rows", [8, 0.25])
@pytest.mark.parametrize("closed", [False, True])
def test_validity_join(spark, bin_rows, closed):
    usage = spark.createDataFrame(USAGE, "sku STRING, begins TIMESTAMP, ends TIMESTAMP")
    prices = spark.createDataFrame(PRICES, "sku STRING, start_at TIMESTAMP, end_at TIMESTAMP, price DOUBLE")
    got = intervals.validity_join(
        usage, prices, ["sku"], F.col("begins"), F.col("start_at"), F.col("end_at"),
        ends_before=F.col("ends") if closed else None, rows_per_bin=bin_rows,
    ).select("sku", "begins", "price")
    want = []
    for sku, begins, ends in USAGE:
        for psku, a, b, price in PRICES:
            if sku is None or sku != psku or a is None or a > begins:
                continue
            if b is None or (ends is not None and ends <= b if closed else begins < b):
                want.append((sku, begins, price))
    assert rows(got) == sorted(want, key=repr)


spans = st.lists(
    st.tuples(st.sampled_from(["x", "y", None]), st.one_of(st.none(), st.integers(-40, 40)), st.one_of(st.none(), st.integers(-5, 60))),
    max_size=40,
)


def brute(left, right, keyed=True):
    def usable(r):
        return (r[0] is not None or not keyed) and r[1] is not None and (r[2] is None or r[1] <= r[2])

    far = float("inf")
    return sorted(
        (i, j)
        for i, a in enumerate(left)
        for j, b in enumerate(right)
        if usable(a) and usable(b) and (a[0] == b[0] or not keyed)
        and a[1] <= (far if b[2] is None else b[2]) and b[1] <= (far if a[2] is None else a[2])
    )


def frames(spark, left, right, kind="INT"):
    a = spark.createDataFrame([(i, *r) for i, r in enumerate(left)], f"i INT, k STRING, lo {kind}, hi {kind}")
    b = spark.createDataFrame([(i, *r) for i, r in enumerate(right)], f"j INT, k STRING, start {kind}, stop {kind}")
    return a, b


def met(a, b, on=("k",), **options):
    b = b if on else b.drop("k")
    spans = (F.col("lo"), F.col("hi")), (F.col("start"), F.col("stop"))
    return sorted(tuple(r) for r in intervals.overlap_join(a, b, list(on), *spans, **options).select("i", "j").collect())


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=spans, right=spans, per_bin=st.sampled_from([0.1, 1, 8]), share=st.sampled_from([1, 1000]))
def test_overlaps_equal_all_pairs(spark, left, right, per_bin, share):
    a, b = frames(spark, left, right)
    assert met(a, b, rows_per_bin=per_bin, least_share=share) == brute(left, right)


@pytest.mark.parametrize("kind", ["BIGINT", "DOUBLE", "DATE", "TIMESTAMP"])
def test_kinds_of_ends_and_no_key(spark, kind):
    rng = random.Random(5)
    left, right = ([(None, x, None if x % 7 == 0 else x + rng.randint(0, 9)) for x in (rng.randint(0, 90) for _ in range(60))] for _ in "ab")
    make = {
        "BIGINT": lambda v: v, "DOUBLE": lambda v: v / 4,
        "DATE": lambda v: date(2024, 1, 1) + timedelta(days=v), "TIMESTAMP": lambda v: datetime(2024, 1, 1) + timedelta(hours=v),
    }[kind]
    typed = [[(k, make(x), None if y is None else make(y)) for k, x, y in side] for side in (left, right)]
    a, b = frames(spark, *typed, kind)
    assert met(a, b, (), rows_per_bin=0.5) == brute(left, right, keyed=False)


def test_a_date_meets_a_timestamp(spark):
    a, _ = frames(spark, [("x", date(2024, 1, 2), date(2024, 1, 2))], [], "DATE")
    _, b = frames(spark, [], [("x", datetime(2024, 1, 1, 5), datetime(2024, 1, 2)), ("x", datetime(2024, 1, 2, 1), None)], "TIMESTAMP")
    assert met(a, b) == [(0, 0)]


def test_one_key_with_nearly_all_rows_is_spread(spark):
    """Readings of one product under a long history and under one open span: no task gets the product."""
    n = 40_000
    readings = spark.range(n).select(F.lit("hot").alias("k"), F.col("id").alias("t"))
    history = spark.range(2_000).select(F.lit("hot").alias("k"), (F.col("id") * 20).alias("s"), (F.col("id") * 20 + 19).alias("e"))
    for right, options in ((history, {}), (history.limit(1).withColumn("e", F.lit(n)), {"least_share": 2_000})):
        pairs = intervals.overlap_join(readings, right, ["k"], (F.col("t"), F.col("t")), (F.col("s"), F.col("e")), **options)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            sizes = [r["count"] for r in pairs.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert sum(sizes) == n and max(sizes) < n // 2


def test_copies_stay_few(spark):
    """Long spans among many short ones: bins are made wider until the mean row has few copies."""
    long_ones = spark.range(500).select(F.lit(1).alias("k"), F.lit(0).alias("s"), F.lit(10_000).alias("e"))
    bins = intervals._bins(
        *(intervals._facts(intervals._on_axis(long_ones, (F.col("s"), F.col("e")), ["k"], (lambda c: c.cast("bigint"), F.lit(2**62))), ["k"], s) for s in "ab"),
        ["k"], 8, 1000,
    )
    assert bins.first()["__bins"] <= intervals.MEAN_COPIES


def test_map_columns_and_clashes(spark):
    a = spark.sql("SELECT 'x' AS k, 1 AS lo, 2 AS hi, map('a', 1) AS m")
    b = spark.sql("SELECT 'x' AS k, 2 AS start, 3 AS stop")
    spans = (F.col("lo"), F.col("hi")), (F.col("start"), F.col("stop"))
    assert intervals.overlap_join(a, b, ["k"], *spans).columns == ["k", "lo", "hi", "m", "start", "stop"]
    with pytest.raises(ValueError):
        intervals.overlap_join(a, b.withColumn("M", F.lit(1)), ["k"], *spans)
