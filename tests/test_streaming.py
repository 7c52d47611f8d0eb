import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from support_core import plan, rows
from pyspark.sql import functions as F

from stratalake.operators.keyed import KeyedParquet
from stratalake.schemas import DEVICE_PAYLOAD
from stratalake.session import LARGE_STATE
from stratalake.sources import bus, files
from stratalake.streaming import devices, jobs

T0 = datetime(2024, 1, 1, 10)
READING = "deviceId STRING, event_timestamp TIMESTAMP, temperature DOUBLE, battery DOUBLE"


def deliver(spark, folder, data, schema=READING):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder)


def reading(minute, device="d1", temperature=20.0, battery=90.0):
    return (device, T0 + timedelta(minutes=minute), temperature, battery)


def summary(spark, path):
    stream = devices.with_lateness(spark.readStream.schema(READING).parquet(f"{path}/in"))
    return jobs.drain(devices.device_summary(stream), f"{path}/out", f"{path}/checkpoint", "summary")


def test_late_rows_restart_and_append(spark, path):
    deliver(spark, f"{path}/in", [reading(0), reading(1), reading(12)])
    first = summary(spark, path)
    assert [(r["window_start"], r["message_count"]) for r in first.collect()] == [(T0, 2)]
    # the mark stands at 10:07: 10:08 is late but kept, 10:02 is dropped
    deliver(spark, f"{path}/in", [reading(8), reading(2), reading(30)])
    second = summary(spark, path)
    got = rows(second.select("window_start", "message_count"), "window_start")
    assert got == [(T0, 2), (T0 + timedelta(minutes=5), 1), (T0 + timedelta(minutes=10), 1)]
    assert rows(summary(spark, path)) == rows(second), "a run without new files adds nothing"


def test_summary_takes_first_and_last_by_event_time(spark):
    data = [reading(3, temperature=30.0), reading(1, temperature=10.0), reading(2, temperature=50.0)]
    got = devices.device_summary(spark.createDataFrame(data, READING)).first()
    assert got["last_temperature"] == 30.0 and got["temperature_range"] == 40.0 and got["avg_temperature"] == 30.0


@pytest.mark.parametrize(
    "temperature,battery,kind,severity,text",
    [
        (30.0, 90.0, None, None, None),
        (30.01, 90.0, "HIGH_TEMPERATURE", "WARNING", "High temperature warning: 30.01°C"),
        (35.0, 90.0, "HIGH_TEMPERATURE", "WARNING", "High temperature warning: 35.0°C"),
        (35.01, 90.0, "CRITICAL_TEMPERATURE", "CRITICAL", "Critical temperature detected: 35.01°C"),
        (20.0, 9.99, "CRITICAL_BATTERY", "CRITICAL", "Critical battery level: 9.99%"),
        (20.0, 10.0, "LOW_BATTERY", "WARNING", "Low battery warning: 10.0%"),
        (20.0, 19.99, "LOW_BATTERY", "WARNING", "Low battery warning: 19.99%"),
        (20.0, 20.0, None, None, None),
        (40.0, 5.0, "CRITICAL_TEMPERATURE", "CRITICAL", "Critical temperature detected: 40.0°C"),
    ],
)
def test_alert_limits(spark, temperature, battery, kind, severity, text):
    got = devices.device_alerts(spark.createDataFrame([reading(0, "d", temperature, battery)], READING)).collect()
    assert [(r["alert_type"], r["severity"], r["alert_message"]) for r in got] == ([(kind, severity, text)] if kind else [])


def test_battery_as_fraction(spark):
    df = spark.createDataFrame([reading(0, "full", 20.0, 0.9), reading(0, "low", 20.0, 0.05)], READING)
    assert [r["deviceId"] for r in devices.device_alerts(df, battery_full=1.0).collect()] == ["low"]
    assert devices.device_alerts(df).count() == 2


def test_messages_with_both_time_forms(spark, path):
    body = json.dumps(
        [
            {"deviceId": "a", "ts": "2025-10-05T18:40:10Z", "temperature": 21.5, "battery": 0.9},
            {"deviceId": "b", "ts": "2025-10-05T18:40:10.250Z", "temperature": 22},
            {"deviceId": "c", "ts": "yesterday"},
        ]
    )
    deliver(spark, f"{path}/in", [(bytearray(body, "utf8"), T0, "0")], "body BINARY, enqueuedTime TIMESTAMP, partition STRING")
    messages = bus.captured_stream(spark, f"{path}/in")
    got = jobs.drain(devices.alert_readings(messages), f"{path}/out", f"{path}/c").orderBy("deviceId").collect()
    assert [r["event_timestamp"] for r in got] == [datetime(2025, 10, 5, 18, 40, 10), datetime(2025, 10, 5, 18, 40, 10, 250000), None]
    full = jobs.drain(devices.full_readings(messages), f"{path}/out2", f"{path}/c2")
    assert full.count() == 3 and full.where("server_ts_utc IS NULL").isEmpty()


def test_json_files_with_rescue(spark, path):
    Path(f"{path}/in").mkdir()
    record = {"deviceId": "a", "ts": "2025-10-05T18:40:10Z", "temperature": 21.5, "humidity": "wet", "firmware": "v2"}
    Path(f"{path}/in/a.json").write_text(json.dumps([record], indent=1))
    raw = files.stream_json_rescued(spark, f"{path}/in", DEVICE_PAYLOAD)
    got = jobs.drain(devices.normalise(raw), f"{path}/out", f"{path}/c").first()
    assert got["humidity"] is None and json.loads(got["_rescued_data"]) == {"humidity": "wet", "firmware": "v2"}


def test_endless_dedup_with_large_state(spark, path):
    schema = "id INT, v INT"
    for k, v in LARGE_STATE.items():
        spark.conf.set(k, v)
    try:
        for batch in ([(1, 1), (2, 1), (1, 2)], [(2, 5), (3, 1)]):
            deliver(spark, f"{path}/in", batch, schema)
            stream = jobs.drop_duplicates_forever(spark.readStream.schema(schema).parquet(f"{path}/in"), ["id"])
            out = jobs.drain(stream, f"{path}/out", f"{path}/c")
        assert rows(out.select("id")) == [(1,), (2,), (3,)]
    finally:
        for k in LARGE_STATE:
            spark.conf.unset(k)


def test_bounded_dedup(spark, path):
    schema = "id INT, ts TIMESTAMP"

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{path}/in")
        return jobs.drain(jobs.drop_duplicates_within(stream, ["id"], "ts", "10 minutes"), f"{path}/out", f"{path}/c")

    deliver(spark, f"{path}/in", [(1, T0), (1, T0 + timedelta(minutes=1)), (2, T0)], schema)
    assert run().count() == 2
    deliver(spark, f"{path}/in", [(1, T0 + timedelta(minutes=2)), (3, T0 + timedelta(minutes=5))], schema)
    assert rows(run().select("id")) == [(1,), (2,), (3,)]


def test_orders_stream_observes_and_drops(spark, path):
    schema = "order_id INT, customer_id INT, order_date STRING, order_total DOUBLE, order_status STRING"
    data = [
        (1, 1, "2024-01-05", 100.0, " delivered "),
        (1, 1, "2024-01-05", 100.0, " delivered "),
        (2, 1, "2024-01-06", -5.0, "SHIPPED"),
        (3, None, "2024-01-06", 50.0, "Pending"),
        (4, 2, "2024-01-07", 3000.0, "cancelled"),
    ]
    deliver(spark, f"{path}/in", data, schema)
    stream = jobs.orders_stream(spark.readStream.schema(schema).parquet(f"{path}/in"), observe="dq")
    query = jobs.append_to_path(stream, f"{path}/out", f"{path}/c", available_now=True)
    query.awaitTermination()
    got = spark.read.parquet(f"{path}/out")
    assert rows(got.select("order_id", "order_status", "order_value_category")) == [(1, "Delivered", "Low"), (2, "Shipped", "Low")]
    seen = [p["observedMetrics"]["dq"] for p in query.recentProgress if "dq" in p["observedMetrics"]]
    assert sum(s["rows"] for s in seen) == 4 and sum(s["valid_order_total"] for s in seen) == 1


def test_orders_of_any_age_are_kept_over_batches(spark, path):
    """A history that arrives in batches out of order: every first copy stays."""
    schema = "order_id INT, customer_id INT, order_date STRING, order_total DOUBLE, order_status STRING"
    batches = [[(1, "2024-03-01")], [(2, "2024-03-05"), (1, "2024-03-01")], [(i, f"2024-01-0{i}") for i in range(3, 8)] + [(2, "2024-03-05")]]
    for batch in batches:
        deliver(spark, f"{path}/in", [(i, 1, day, 10.0, "shipped") for i, day in batch], schema)
        stream = jobs.orders_stream(spark.readStream.schema(schema).parquet(f"{path}/in"))
        jobs.append_to_path(stream, f"{path}/out", f"{path}/c", available_now=True).awaitTermination()
    assert rows(spark.read.parquet(f"{path}/out").select("order_id")) == [(i,) for i in range(1, 8)]


def test_customers_stream(spark, path):
    schema = "customer_id INT, email STRING, name STRING, city STRING, state STRING, country STRING, signup_date STRING"
    data = [
        (1, " A@X.COM", " Ann ", "new york", " ny", "usa", "2023-08-01"),
        (1, " A@X.COM", " Ann ", "new york", " ny", "usa", "2023-08-01"),
        (2, None, "   ", "x", "y", "z", "2020-01-01"),
        (None, None, "Bo", "x", "y", "z", "2020-01-01"),
    ]
    deliver(spark, f"{path}/in", data, schema)
    stream = jobs.customers_stream(spark.readStream.schema(schema).parquet(f"{path}/in"), F.lit("2024-01-31").cast("date"))
    got = jobs.drain(stream, f"{path}/out", f"{path}/c").collect()
    assert len(got) == 1
    assert (got[0]["city"], got[0]["state"], got[0]["email"]) == ("New York", "NY", "a@x.com")
    assert (got[0]["customer_tenure_days"], got[0]["customer_tenure_segment"]) == (183, "Growing")


CHANGE = "id INT, seq INT, v STRING, _rescued_data STRING"


def changes(spark, path, target, rules=None, name="feed"):
    feed = spark.readStream.schema(CHANGE).parquet(f"{path}/in")
    return jobs.change_stream(feed, target, "seq", f"{path}/c", rules, ["_rescued_data", "seq"], name)


def test_change_stream_order_replay_and_failure(spark, path):
    target = KeyedParquet(spark, f"{path}/t", ["id"])
    deliver(spark, f"{path}/in", [(1, 5, "five", None), (2, 1, "one", None), (1, 4, "four", None)], CHANGE)
    changes(spark, path, target).awaitTermination()
    deliver(spark, f"{path}/in", [(1, 3, "late", None), (2, 2, "two", None)], CHANGE)
    changes(spark, path, target).awaitTermination()
    assert rows(jobs.current_rows(target, ["seq"])) == [(1, "five"), (2, "two")]
    # the same batch again, as after a crash between store and commit
    target.apply_changes(spark.createDataFrame([(1, 3, "late"), (2, 2, "two")], "id INT, seq INT, v STRING"), "seq")
    # a second feed with a checkpoint of its own
    deliver(spark, f"{path}/other/in", [(8, 1, "eight", None), (2, 1, "old", None)], CHANGE)
    changes(spark, f"{path}/other", target).awaitTermination()
    before = rows(target.read())
    assert rows(jobs.current_rows(target, ["seq"])) == [(1, "five"), (2, "two"), (8, "eight")]
    # a broken rule stops the batch and leaves the table alone
    deliver(spark, f"{path}/in", [(None, 9, "bad", None), (5, 1, "good", None)], CHANGE)
    with pytest.raises(Exception, match="expectation failed: has_id"):
        changes(spark, path, target, {"has_id": "id IS NOT NULL"}).awaitTermination()
    assert rows(target.read()) == before


def test_table_sink_and_status(spark, path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS st")
    spark.sql("DROP TABLE IF EXISTS st.readings")
    deliver(spark, f"{path}/in", [reading(0), reading(1)])
    stream = spark.readStream.schema(READING).parquet(f"{path}/in")
    running = jobs.append_to_table(stream, "st.readings", f"{path}/c", "to_table")
    running.processAllAvailable()
    assert [q["name"] for q in jobs.active_queries(spark)] == ["to_table"]
    running.stop()
    assert spark.table("st.readings").count() == 2 and jobs.active_queries(spark) == []


def test_exact_distinct_is_not_offered_on_streams(spark, path):
    from stratalake.plans.sales_metrics import geographic_sales

    schema = "order_id INT, customer_id INT, order_date TIMESTAMP, order_total DOUBLE, order_status STRING"
    data = [(i, i % 3, datetime(2024, 1, 1 + i), 10.0, "Delivered") for i in range(9)] + [(99, 1, datetime(2024, 6, 1), 5.0, "Shipped")]
    deliver(spark, f"{path}/in", data, schema)
    customers = spark.createDataFrame([(c, "USA", "NY") for c in range(3)], "customer_id INT, country STRING, state STRING")
    out = jobs.drain(jobs.geographic_stream(spark.readStream.schema(schema).parquet(f"{path}/in"), customers), f"{path}/out", f"{path}/c")
    got = out.collect()
    batch = geographic_sales(spark.createDataFrame(data[:-1], schema), customers).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in batch]
    assert got[0]["unique_customers"] == 3 and got[0]["revenue_per_customer"] == 30.0


def test_customers_are_not_broadcast_to_window_sums(spark, path):
    from stratalake.plans.sales_metrics import geographic_sales

    orders = spark.createDataFrame([("o1", "c1", "2024-01-03", 5.0, "Delivered")], "order_id STRING, customer_id STRING, order_date STRING, order_total DOUBLE, order_status STRING")
    spark.createDataFrame([("c1", "Spain", "Leon")], "customer_id STRING, country STRING, state STRING").write.parquet(path + "/c")
    customers = spark.read.parquet(path + "/c")  # files of a known, small size
    found = geographic_sales(orders.withColumn("order_date", F.to_timestamp("order_date")), customers)
    text = plan(found, "simple")
    assert "SortMergeJoin" in text and "Broadcast" not in text
    assert [(r.country, r.total_orders, r.unique_customers, r.delivered_revenue) for r in found.collect()] == [("Spain", 1, 1, 5.0)]


def test_scattered_tables_get_more_files_not_longer_ones(spark, path, monkeypatch):
    from stratalake.queries import streams

    monkeypatch.setattr(streams, "SCATTERED_ROWS", 100, raising=False)
    spark.range(4000).selectExpr("id", "id % 3 AS part_of").repartition(1).write.parquet(f"{path}/t.parquet")
    seen = []
    for by in ("id", "part_of"):  # every value, or one of three
        stream = streams.scattered_stream(spark, path, "t", by)
        batches = []
        query = stream.writeStream.foreachBatch(lambda b, i: batches.append([r[1] for r in b.groupBy(F.input_file_name()).count().collect()])).trigger(availableNow=True).start()
        query.awaitTermination()
        assert sum(sum(b) for b in batches) == 4000 and 2 <= len(batches) <= 4
        seen.append(max(max(b, default=0) for b in batches))
    assert seen[0] < 200 and seen[1] < 500  # rows of one file
