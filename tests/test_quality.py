from datetime import datetime

import pytest
from support_core import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from stratalake.operators import quality as q
from stratalake.plans import loads
from stratalake.schemas import RAW_SALES

TS = datetime(2024, 1, 15, 10)
RAW = [
    ("e1", "c1", "p1", 2, 10.0, " eur ", " us ", TS, "web"),
    ("e2", "c1", "p1", 1, 10.0, "JPY", "eu", TS, "web"),
    ("e3", "c2", "p1", 3, 2.0, None, "eu", TS, "web"),
    ("e4", "c2", "p1", 1, 1.0, "GBP", "eu", TS, "web"),
    ("e5", "c2", "p1", 1, 1.0, "cad", "eu", TS, "web"),
    (None, "c2", "p1", 1, 1.0, "USD", "eu", TS, "web"),
    ("e7", "c2", "p1", 1, 1.0, "USD", "eu", None, "web"),
    ("e8", "c2", "p1", 0, 1.0, "USD", "eu", TS, "web"),
    ("e9", "c2", "p1", -1, 1.0, "USD", "eu", TS, "web"),
    ("e10", "c2", "p1", None, 1.0, "USD", "eu", TS, "web"),
    ("e11", "c2", "p1", 1, 0.0, "USD", "eu", TS, "web"),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(RAW, RAW_SALES)


def test_clean_sales(raw):
    cleaned, metrics = q.clean_and_enrich_sales(raw, "2024-01-15")
    got = {r["event_id"]: r for r in cleaned.collect()}
    assert {k: round(r["revenue_usd"], 6) for k, r in got.items()} == {"e1": 21.6, "e2": 10.0, "e3": 6.0, "e4": 1.27, "e5": 0.74}
    assert got["e1"]["currency"] == "EUR" and got["e1"]["region"] == "US" and got["e1"]["event_date"] == "2024-01-15"
    assert metrics == {
        "input_records": 11, "output_records": 5, "null_records_dropped": 2, "invalid_amount_dropped": 4,
        "total_records_dropped": 6, "pass_rate_pct": 45.45, "execution_date": "2024-01-15",
    }


def test_clean_empty_input(raw):
    _, metrics = q.clean_and_enrich_sales(raw.where("FALSE"), "2024-01-15")
    assert metrics["input_records"] == 0 and metrics["pass_rate_pct"] == 0


def test_validate_output(raw):
    cleaned = q.clean_sales(raw, "2024-01-15")
    with pytest.warns(UserWarning, match="low record count"):
        assert q.validate_output(cleaned)
    with pytest.warns(UserWarning):
        assert not q.validate_output(cleaned, 95.0, 45.45)
    with pytest.warns(UserWarning):
        assert not q.validate_output(cleaned.withColumn("revenue_usd", F.lit(-1.0)))


RULES = {"has_id": "id IS NOT NULL", "positive": "v > 0"}


@pytest.fixture
def some(spark):
    return spark.createDataFrame([(1, 5), (2, -5), (None, 5), (4, None), (None, -1)], "id INT, v INT")


def test_drop_and_split(some):
    assert rows(q.expect_all_or_drop(some, RULES)) == [(1, 5)]
    assert q.expect_or_drop(some, "positive", "v > 0").count() == 2
    passed, held = q.split(some, RULES)
    assert rows(passed) == [(1, 5)]
    assert passed.count() + held.count() == some.count()
    names = sorted(tuple(r["failed_rules"]) for r in held.collect())
    assert names == [("has_id",), ("has_id", "positive"), ("positive",), ("positive",)]


def test_counts_and_observation(some):
    assert rows(q.violations(some, RULES)) == [("has_id", 2, 5), ("positive", 3, 5)]
    seen = Observation("dq")
    assert q.expect(some, RULES, seen).count() == 5
    assert seen.get == {"rows": 5, "has_id": 2, "positive": 3}


def test_fail(some):
    with pytest.raises(Exception, match="expectation failed: positive|expectation failed: has_id"):
        q.expect_all_or_fail(some, RULES).count()
    assert q.expect_all_or_fail(some.where("id = 1"), RULES).count() == 1
    with pytest.raises(q.ExpectationFailed, match="has_id"):
        q.require(some, RULES)


def test_registry():
    assert "valid_quantity" in q.rules_for("order_items")
    with pytest.raises(ValueError):
        q.rules_for("unknown")


def test_star_checks(spark):
    fact = spark.createDataFrame([(1, 1, 1), (1, None, 2), (2, 3, None)], "sale_id INT, product_sk INT, customer_sk INT")
    assert q.missing_dimensions(fact).first()[0] == 2
    loaded = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 5),)], "t TIMESTAMP")
    for day, stale in (("2024-01-07", False), ("2024-01-09", True)):
        assert q.freshness(loaded, "t", F.lit(day).cast("timestamp")).first()["is_stale"] is stale


def test_alerts(spark):
    daily = spark.createDataFrame(
        [("2024-01-01", 100.0, 20), ("2024-01-02", 0.0, 20), ("2024-01-04", 50.0, 12), ("2024-01-05", 30.0, 9)],
        "date STRING, total_revenue DOUBLE, total_orders INT",
    ).withColumn("date", F.col("date").cast("date"))
    change = [r["revenue_change_pct"] for r in q.revenue_change(daily).orderBy("date").collect()]
    assert change == [None, -100.0, None, -40.0]  # no percentage of a zero
    assert q.revenue_alert(daily).first()["alert"] and q.order_alert(daily).first()["alert"]
    before = daily.where("date < '2024-01-05'")
    assert not q.revenue_alert(before).first()["alert"] and not q.order_alert(before).first()["alert"]


@pytest.mark.filterwarnings("ignore:very low")
def test_daily_run(spark, raw, path):
    raw.write.parquet(f"{path}/in/date=2024-01-15")
    result = loads.run_daily_sales(spark, f"{path}/in", f"{path}/out", "2024-01-15")
    assert result["success"] and result["records_written"] == 5
    loads.run_daily_sales(spark, f"{path}/in", f"{path}/out", "2024-01-15")
    assert spark.read.parquet(f"{path}/out").count() == 5, "a repeated day must not duplicate rows"
    with pytest.raises(RuntimeError, match="validation failed"):
        loads.run_daily_sales(spark, f"{path}/in", f"{path}/strict", "2024-01-15", min_pass_rate=95.0)
    from pathlib import Path

    assert not Path(f"{path}/strict").exists()


def test_publish_or_quarantine(spark, some, path):
    for _ in range(2):  # a repeated run replaces its own rows
        loads.publish_or_quarantine(some, RULES, f"{path}/good", f"{path}/bad", "2024-01-15")
    assert spark.read.parquet(f"{path}/good").count() == 1 and spark.read.parquet(f"{path}/bad").count() == 4


def test_post_checks(spark):
    orders = spark.createDataFrame([("c1", 5.0), ("c2", 1.0)], "customer_id STRING, total_amount DOUBLE")
    daily = spark.createDataFrame([("2024-01-01",)], "date STRING")
    good = {"orders": orders, "sales_daily_metrics": daily, "fs_order_features": orders}
    assert all(loads.post_checks(spark, good).values())
    bad = {**good, "fs_order_features": orders.limit(1)}
    assert not loads.post_checks(spark, bad)["features cover all customers"]


@pytest.mark.filterwarnings("ignore:very low")
def test_late_events_leave_earlier_days_alone(spark, raw, path):
    day = F.to_timestamp(F.lit("2024-01-10 12:00:00"))
    first, late = raw.withColumn("event_timestamp", day), raw.withColumn("event_timestamp", day).limit(3)
    first.write.parquet(f"{path}/in/date=2024-01-10")
    late.unionByName(raw).write.parquet(f"{path}/in/date=2024-01-11")
    written = [loads.run_daily_sales(spark, f"{path}/in", f"{path}/out", f"2024-01-{d}")["records_written"] for d in (10, 11, 10)]
    assert written[0] == written[2] and spark.read.parquet(f"{path}/out").count() == written[0] + written[1]
