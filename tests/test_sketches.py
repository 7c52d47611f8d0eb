import random
from datetime import date, timedelta

from pyspark.sql import functions as F
from support_core import plan

from stratalake.operators import sketches


def frame(spark, n=20_000):
    rng = random.Random(11)
    data = [
        (date(2024, 1, 1) + timedelta(days=rng.randint(0, 89)), rng.choice("ab"), rng.randint(1, 3_000), rng.randint(0, 10**6) / 100)
        for _ in range(n)
    ]
    return data, spark.createDataFrame(data, "d DATE, g STRING, who INT, amount DOUBLE").repartition(6)


def daily(df):
    return sketches.daily_sketches(
        df, F.col("d"), ["g"], {"cents": F.round(F.col("amount") * 100).cast("bigint")}, {"people": F.col("who")}, {"amount": F.col("amount")}
    )


def test_months_and_quarters_from_days(spark, path):
    data, df = frame(spark)
    daily(df).write.mode("overwrite").parquet(path)  # sketches are plain columns
    stored = spark.read.parquet(path)
    month = sketches.roll_up(stored, F.trunc("day", "month"), ["g"])
    quarter = sketches.roll_up(month, F.trunc("day", "quarter"), [])
    for table, key in ((month, lambda r: (r[0].replace(day=1), r[1])), (quarter, lambda r: date(2024, 1, 1))):
        got = sketches.read_off(table, {"median": ("amount", 0.5), "p95": ("amount", 0.95)}).collect()
        assert len(got) == (6 if table is month else 1)
        for row in got:
            mine = [r for r in data if key(r) == ((row["day"], row["g"]) if table is month else row["day"])]
            assert row["n_rows"] == len(mine) and row["cents"] == sum(round(r[3] * 100) for r in mine)
            people = len({r[2] for r in mine})
            assert abs(row["people"] - people) <= 0.04 * people
            for name, rank in (("median", 0.5), ("p95", 0.95)):
                assert abs(sum(r[3] <= row[name] for r in mine) / len(mine) - rank) < 0.03


def test_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a", None, None), (date(2024, 1, 1), None, None, None)], "d DATE, g STRING, who INT, amount DOUBLE")
    got = sketches.read_off(sketches.roll_up(daily(df), F.trunc("day", "year"), ["g"]), {"median": ("amount", 0.5)})
    assert sorted((r["n_rows"], r["people"], r["median"]) for r in got.collect()) == [(1, 0, None), (1, 0, None)]
    assert sketches.read_off(daily(df.limit(0)), {"median": ("amount", 0.5)}).count() == 0


def test_a_hot_day_is_merged_before_the_shuffle(spark):
    text = plan(daily(frame(spark, 100)[1]), "simple")
    assert text.count("ObjectHashAggregate") == 2 and "partial_hll_sketch_agg" in text and "partial_kll_sketch_agg" in text
