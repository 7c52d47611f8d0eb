import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from support_core import plan, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratalake.operators import ranges
from stratalake.operators.ranges import add_dense_rank, add_row_number, range_of, sample_bounds

KINDS = {
    "STRING": lambda r: "".join(r.choice("aAzéß漢~0 ") for _ in range(r.randint(0, 5))),
    "BIGINT": lambda r: r.randint(-(10**12), 10**12),
    "DOUBLE": lambda r: r.uniform(-1e6, 1e6),
    "DATE": lambda r: (datetime(2020, 1, 1) + timedelta(days=r.randint(0, 900))).date(),
    "TIMESTAMP": lambda r: datetime(2020, 1, 1) + timedelta(microseconds=r.randint(0, 10**14)),
    "DECIMAL(12,2)": lambda r: Decimal(r.randint(-(10**6), 10**6)) / 100,
}


@pytest.mark.parametrize("kind", KINDS)
def test_row_number_equals_global_window(spark, kind):
    rng = random.Random(7)
    data = [(KINDS[kind](rng), i) for i in range(400)]
    df = spark.createDataFrame(data, f"k {kind}, i INT").repartition(5)
    got = add_row_number(df, ["k", "i"], "n", ranges=7)
    want = df.withColumn("n", F.row_number().over(Window.orderBy("k", "i")).cast("bigint"))
    assert rows(got.select("i", "n")) == rows(want.select("i", "n"))


def test_dense_rank_with_a_hot_key_and_nulls(spark):
    data = [("hot" if i % 3 else None if i % 5 == 0 else f"k{i % 40}", i % 4) for i in range(900)]
    df = spark.createDataFrame(data, "a STRING, b INT").repartition(6)
    got = add_dense_rank(df, ["a", "b"], "n", ranges=9)
    want = df.withColumn("n", F.dense_rank().over(Window.orderBy("a", "b")).cast("bigint"))
    assert rows(got) == rows(want)
    ids = [r[0] for r in got.select("n").distinct().orderBy("n").collect()]
    assert ids == list(range(1, len(ids) + 1))


def test_one_column_with_nulls(spark):
    for kind, make in (("INT", lambda i: i * 37 % 101), ("STRING", lambda i: f"k{i * 37 % 101}")):
        data = [(None if i % 6 == 0 else make(i),) for i in range(500)]
        df = spark.createDataFrame(data, f"k {kind}").repartition(4)
        want = df.withColumn("n", F.dense_rank().over(Window.orderBy("k")).cast("bigint"))
        assert rows(add_dense_rank(df, ["k"], "n", ranges=8)) == rows(want)


def test_few_rows(spark):
    empty = spark.createDataFrame([], "k INT")
    assert add_row_number(empty, ["k"], "n").count() == 0
    assert rows(add_row_number(spark.createDataFrame([(5,)], "k INT"), ["k"], "n")) == [(5, 1)]


def test_range_of_counts_the_bounds_below(spark):
    df = spark.range(100).select(F.col("id").alias("k"))
    bounds = [(10,), (20,), (30,), (40,), (50,)]
    got = {r["k"]: r["r"] for r in df.withColumn("r", range_of(df, ["k"], bounds)).collect()}
    assert all(got[k] == sum(b[0] < k for b in bounds) for k in got)


def test_bounds_are_few_and_balanced(spark):
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_003).alias("k"))
    bounds = sample_bounds(df, ["k"], 10)
    assert len(bounds) == 9
    sizes = [r["count"] for r in df.groupBy(range_of(df, ["k"], bounds)).count().collect()]
    assert max(sizes) < 3 * min(sizes)


def test_ranges_stay_even_with_a_hot_key(spark):
    """Nine rows in ten under one key: no range holds much more than its share."""
    df = spark.range(200_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("k"), "id")
    got = add_row_number(df, ["k"], "n", ranges=12)
    assert got.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first() == (1, 200_000, 200_000)
    assert got.where("n <= 180000 AND k <> -1").isEmpty()
    tied = df.withColumn("tie", F.xxhash64("k", "id"))
    bounds = sample_bounds(tied, ["k", "tie"], 12)
    sizes = [r["count"] for r in tied.groupBy(range_of(tied, ["k", "tie"], bounds)).count().collect()]
    assert max(sizes) < 2.5 * 200_000 / 12
    dense = add_dense_rank(df, ["k"], "n", ranges=12)
    assert dense.agg(F.max("n")).first()[0] == 20_001 and dense.where("k = -1").agg(F.max("n")).first()[0] == 1


def test_dense_rank_of_rare_keys_takes_one_exchange_by_range(spark):
    df = spark.range(20_000).select((F.col("id") / 2).cast("long").alias("k"), "id")
    text = plan(add_dense_rank(df, ["k"], "n", ranges=6), "simple")
    assert text.count("Exchange hashpartitioning(__range") <= 2 and "SortMergeJoin" not in text


def test_numbers_from_sorted_files(spark, monkeypatch):
    """A table that asks for more ranges than the bounds allowed as literals."""
    rng = random.Random(3)
    data = [(None if i % 11 == 0 else rng.choice(["hot", "hot", f"k{i % 50}"]), i) for i in range(700)]
    df = spark.createDataFrame(data, "k STRING, i INT").repartition(5)
    monkeypatch.setattr(ranges, "MOST_RANGES", 4)
    got = add_row_number(df, ["k", "i"], "n", ranges=9)
    want = df.withColumn("n", F.row_number().over(Window.orderBy("k", "i")).cast("bigint"))
    assert got.schema.simpleString() == want.schema.simpleString() and rows(got) == rows(want)
    tied = add_row_number(df, ["k"], "n", ranges=9)
    assert sorted(r["n"] for r in tied.collect()) == list(range(1, 701))
    assert tied.where("k IS NULL").agg(F.max("n")).first()[0] == tied.where("k IS NULL").count()
    dense = add_dense_rank(df, ["k"], "n", ranges=9)
    assert rows(dense) == rows(df.withColumn("n", F.dense_rank().over(Window.orderBy("k")).cast("bigint")))
    empty = ranges.numbered_in_files(df.limit(0), ["k"], "n", 3)
    assert empty.count() == 0
    assert len(sample_bounds(df, ["i"], 10**6)) < 4


@pytest.mark.parametrize("add", [add_dense_rank, add_row_number])
def test_a_number_that_nobody_reads_costs_nothing(spark, path, add):
    spark.range(1000).selectExpr("id % 400 AS k", "id AS v").write.parquet(path + "/t")
    df = spark.read.parquet(path + "/t")
    numbered = add(df, ["k", "v"], "n", ranges=4)
    text = plan(numbered.agg(F.sum("v")), "simple")
    assert "Join" not in text and "lambda" not in text
    assert sorted(r.n for r in numbered.collect()) == list(range(1, 1001))
