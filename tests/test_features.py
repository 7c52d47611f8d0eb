import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from support_core import order_frame, plan, rows

from stratalake.operators import history
from stratalake.plans.sales_metrics import order_feature_table
from stratalake.schemas import FEATURES

ADDERS = {
    "label_next_order_amount": (history.add_label_next_order_amount, [150.0, 200.0, None]),
    "last_order_amount": (history.add_last_order_amount, [None, 100.0, 150.0]),
    "days_since_prev_order": (history.add_days_since_prev_order, [None, 4, 5]),
    "purchase_count_to_date": (history.add_purchase_count_to_date, [0, 1, 2]),
    "hist_avg_purchase": (history.add_hist_avg_purchase, [None, 100.0, 125.0]),
    "total_spend_to_date": (history.add_total_spend_to_date, [None, 100.0, 250.0]),
}


@pytest.mark.parametrize("column", ADDERS)
def test_each_feature(orders, column):
    add, expected = ADDERS[column]
    got = add(orders).where("customer_id = 'C001'").orderBy("order_date").select(column).collect()
    assert [r[0] for r in got] == expected


def test_second_customer_is_independent(orders):
    got = history.order_features(orders).where("customer_id = 'C002'").orderBy("order_date").collect()
    assert got[0]["last_order_amount"] is None and got[-1]["label_next_order_amount"] is None
    assert [r["purchase_count_to_date"] for r in got] == [0, 1]


def test_chained_adders_keep_rows_and_columns(orders):
    df = orders
    for add, _ in ADDERS.values():
        df = add(df)
    assert df.count() == 5
    assert set(ADDERS) < set(df.columns)


def test_empty_single_and_same_day(spark):
    empty = order_frame(spark, [])
    assert history.order_features(empty).count() == 0
    one = history.order_features(order_frame(spark, [("C001", "ORD001", "2023-01-01", 100.0)])).first()
    assert one["purchase_count_to_date"] == 0 and one["total_spend_to_date"] is None
    same = [("C001", "ORD001", "2023-01-10", 80.0), ("C001", "ORD002", "2023-01-10", 120.0), ("C001", "ORD003", "2023-01-10", 50.0)]
    got = rows(history.order_features(order_frame(spark, same)).select("order_id", "last_order_amount", "days_since_prev_order"), "order_id")
    assert got == [("ORD001", None, None), ("ORD002", 80.0, 0), ("ORD003", 120.0, 0)]


NULL_ROWS = [
    ("C001", "ORD001", "2023-01-01", 100.0),
    ("C001", "ORD002", "2023-01-05", None),
    ("C002", "ORD003", "2023-01-02", 50.0),
    ("C002", "ORD004", None, 75.0),
]


@pytest.mark.parametrize("hot_rows", [10**6, 1])
def test_nulls(spark, hot_rows):
    got = history.order_features(order_frame(spark, NULL_ROWS), hot_rows=hot_rows)
    by_id = {r["order_id"]: r for r in got.collect()}
    # a NULL date sorts first
    assert by_id["ORD004"]["purchase_count_to_date"] == 0 and by_id["ORD004"]["label_next_order_amount"] == 50.0
    assert by_id["ORD003"]["last_order_amount"] == 75.0 and by_id["ORD003"]["days_since_prev_order"] is None
    assert by_id["ORD002"]["total_spend_to_date"] == 100.0 and by_id["ORD001"]["label_next_order_amount"] is None


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_split_of_hot_customers_equals_plain_windows(spark, seed):
    rng = random.Random(seed)
    data = []
    for i in range(600):
        customer = "HOT" if rng.random() < 0.6 else f"C{rng.randint(1, 60)}"
        day = None if rng.random() < 0.02 else str(date(2023, 1, 1) + timedelta(days=rng.randint(0, 40)))
        amount = None if rng.random() < 0.1 else float(rng.randint(1, 500))
        data.append((customer, f"O{i:04d}", day, amount))
    df = order_frame(spark, data)
    assert rows(history.order_features(df, hot_rows=50)) == rows(history.order_features(df))


def test_feature_table_has_declared_types(spark, orders):
    table = order_feature_table(orders.withColumnRenamed("order_amount", "total_amount"))
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in FEATURES]


def test_all_features_share_one_exchange_and_sort(orders):
    text = plan(history.order_features(orders), "simple")
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Sort [") == 1


def test_one_schema_for_hot_and_plain_amounts(spark):
    df = order_frame(spark, [("HOT" if i % 3 else "C", f"O{i:03d}", f"2023-01-{i % 28 + 1:02d}", float(i) + 0.25) for i in range(90)])
    for kind in ("decimal(10,2)", "double", "float", "int"):
        typed = df.withColumn("order_amount", df.order_amount.cast(kind))
        plain, hot = history.order_features(typed), history.order_features(typed, hot_rows=20)
        assert hot.schema == plain.schema
        assert rows(hot) == rows(plain)


def test_job_names_count_per_workspace(spark):
    from stratalake.plans import monitoring

    runs = spark.createDataFrame(
        [("a", 1, 10, "FAILED"), ("b", 1, 11, "FAILED"), ("b", 1, 12, "SUCCESS")], "workspace_id STRING, job_id LONG, run_id LONG, result_state STRING"
    ).selectExpr("*", "TIMESTAMP '2024-05-02 10:00:00' AS start_time", "TIMESTAMP '2024-05-02 10:30:00' AS end_time", "'x' AS state_message")
    jobs = spark.createDataFrame(
        [("a", 1, "load", 1), ("a", 1, "load new", 2), ("b", 1, "export", 3)], "workspace_id STRING, job_id LONG, name STRING, change_time LONG"
    )
    as_of = F.lit("2024-05-03 00:00:00").cast("timestamp")
    failed = monitoring.recent_failures(runs, jobs, as_of)
    assert [(r.job_name, r.run_id) for r in failed.collect()] == [("load new", 10), ("export", 11)]
    trend = monitoring.duration_trend(runs, jobs, as_of)
    assert [(r.job_name, r.run_count, r.failure_count) for r in trend.collect()] == [("export", 2, 1), ("load new", 1, 1)]
    merged = monitoring.duration_trend(runs.drop("workspace_id"), jobs.drop("workspace_id"), as_of)
    assert [(r.job_name, r.run_count) for r in merged.collect()] == [("export", 3)]
