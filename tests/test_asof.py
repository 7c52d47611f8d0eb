"""As-of joins against brute force; plain and split keys agree."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from support_core import plan

from stratalake.operators import asof
from stratalake.operators.asof import as_of_join

DAY = dt.datetime(2024, 1, 1)


def data(spark, seed, n=400):
    rng = random.Random(seed)
    day = lambda: rng.choice([None, *[DAY + dt.timedelta(days=rng.randrange(60)) for _ in range(12)]])
    key = lambda: rng.choice([None, "hot", "hot", "hot", "hot", "hot", "a", "b"])
    events = [(i, key(), day()) for i in range(n)] + [(0, "hot", DAY)] * 3
    versions = [(key(), day(), rng.choice([None, 1.0, 2.0, 3.0]), j % 7) for j in range(n // 2)]
    return (
        events,
        versions,
        spark.createDataFrame(events, "event_id INT, k STRING, at TIMESTAMP_NTZ"),
        spark.createDataFrame(versions, "k STRING, since TIMESTAMP_NTZ, score DOUBLE, no INT"),
    )


def brute(events, versions, strictly, age=None):
    out = []
    for i, k, at in events:
        usable = [v for v in versions if k is not None and at is not None and v[0] == k and v[1] is not None and (v[1] < at if strictly else v[1] <= at)]
        best = max(usable, key=lambda v: (v[1], v[3], v[2] is not None, v[2] or 0), default=None)
        if best and age is not None and best[1] < at - dt.timedelta(days=age):
            best = None
        out.append((i, k, at, *((best[2], best[3]) if best else (None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_rows", [5_000_000, 20])
@pytest.mark.parametrize("strictly, age", [(False, None), (True, None), (False, 3), (True, 5)])
def test_like_brute_force(spark, hot_rows, strictly, age):
    events, versions, e, v = data(spark, 3)
    limit = None if age is None else F.expr(f"INTERVAL {age} DAYS")
    found = as_of_join(e, v, ["k"], "at", "since", ["score", "no"], ["no"], limit, strictly, hot_rows)
    assert found.columns == ["event_id", "k", "at", "score", "no"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(events, versions, strictly, age)


def test_one_instant_larger_than_a_range(spark):
    events = [(i, "hot", DAY + dt.timedelta(days=i % 2)) for i in range(300)]
    versions = [("hot", DAY, 1.0, 0), ("hot", DAY + dt.timedelta(days=1), 2.0, 0)]
    e, v = spark.createDataFrame(events, "event_id INT, k STRING, at TIMESTAMP_NTZ"), spark.createDataFrame(versions, "k STRING, since TIMESTAMP_NTZ, score DOUBLE, no INT")
    found = as_of_join(e, v, ["k"], "at", "since", ["score"], hot_rows=20).collect()
    assert {(r.event_id, r.score) for r in found} == {(i, 1.0 + i % 2) for i in range(300)}


def test_empty_sides_and_clashing_names(spark):
    _, _, e, v = data(spark, 1, 20)
    assert as_of_join(e.where("false"), v, ["k"], "at", "since", ["score"]).count() == 0
    found = as_of_join(e, v.where("false"), ["k"], "at", "since", ["score"])
    assert found.count() == e.count() and found.where("score IS NOT NULL").count() == 0
    with pytest.raises(ValueError, match="at"):
        as_of_join(e, v.withColumnRenamed("no", "AT"), ["k"], "at", "since", ["AT"])


def test_one_exchange(spark, path):
    _, _, e, v = data(spark, 2)
    e.write.parquet(f"{path}/e")
    v.write.parquet(f"{path}/v")
    found = as_of_join(spark.read.parquet(f"{path}/e"), spark.read.parquet(f"{path}/v"), ["k"], "at", "since", ["score"])
    text = plan(found, "simple")
    assert text.count("Exchange") == 1 and text.count("Sort [") == 1 and "Join" not in text


@pytest.mark.parametrize("strictly", [False, True])
def test_long_and_short_hot_keys_like_brute_force(spark, strictly):
    rng = random.Random(5)
    key = lambda: rng.choice(["long"] * 12 + ["a", "b", "c", "d", None])
    day = lambda: DAY + dt.timedelta(days=rng.randrange(40))
    events = [(i, key(), day()) for i in range(500)]
    versions = [(key(), day(), float(j), j) for j in range(120)]
    e, v = spark.createDataFrame(events, "event_id INT, k STRING, at TIMESTAMP_NTZ"), spark.createDataFrame(versions, "k STRING, since TIMESTAMP_NTZ, score DOUBLE, no INT")
    found = as_of_join(e, v, ["k"], "at", "since", ["score", "no"], ["no"], None, strictly, hot_rows=20)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(events, versions, strictly)


def test_keys_just_over_the_limit_stay_in_few_ranges(spark):
    """200 keys of 12 rows each, of which 10 are allowed: not a range a row, and the rows are computed once to count and once to store."""
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    e = spark.createDataFrame([(i, i % 200, DAY + dt.timedelta(hours=i)) for i in range(2000)], "event_id INT, k INT, at TIMESTAMP_NTZ")
    v = spark.createDataFrame([(i % 200, DAY + dt.timedelta(hours=5 * i), float(i)) for i in range(400)], "k INT, since TIMESTAMP_NTZ, score DOUBLE")
    e = e.mapInArrow(counted, e.schema)
    assert as_of_join(e, v, ["k"], "at", "since", ["score"], hot_rows=10).count() == 2000
    assert made.value <= 3 * 2000  # counted, stored, and searched for rows without a key
    both = asof._stored(e.select("k", F.col("at").alias(asof.TIME), F.lit(1).alias(asof.SIDE), F.xxhash64("event_id").alias(asof.SPREAD), F.lit(12).alias(asof.COUNT)))
    hot = both.groupBy("k").agg(F.lit(12).cast("bigint").alias(asof.COUNT))
    assert both.withColumn("r", asof._range(both, hot, 10)).select("k", "r").distinct().count() <= 3 * 200
