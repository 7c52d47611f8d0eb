"""Device telemetry: parse, normalise, summarise per window, raise alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.scalars import alert_message, alert_severity, alert_type, parse_event_time
from stratalake.schemas import DEVICE_ALERT_PAYLOAD, DEVICE_PAYLOAD

WINDOW = "5 minutes"
LATENESS = "5 minutes"


def explode_messages(messages: DataFrame, payload: T.StructType) -> DataFrame:
    """One row per payload of each message's JSON array."""
    arrays = messages.select(
        F.col("enqueuedTime").alias("eh_enqueued_ts"),
        "partition",
        F.from_json(F.col("body").cast("string"), T.ArrayType(payload)).alias("arr"),
    )
    return arrays.select("eh_enqueued_ts", "partition", F.explode("arr").alias("event"))


def full_readings(messages: DataFrame) -> DataFrame:
    fields = [f.name for f in DEVICE_PAYLOAD.fields if f.name != "ts"]
    return explode_messages(messages, DEVICE_PAYLOAD).select(
        "eh_enqueued_ts",
        "partition",
        F.col("event.deviceId"),
        F.col("event.ts").alias("local_ts"),
        *[F.col(f"event.{f}") for f in fields if f != "deviceId"],
        F.current_timestamp().alias("server_ts_utc"),
    )


def alert_readings(messages: DataFrame) -> DataFrame:
    return explode_messages(messages, DEVICE_ALERT_PAYLOAD).select(
        "eh_enqueued_ts",
        "partition",
        F.col("event.deviceId"),
        parse_event_time("event.ts").alias("event_timestamp"),
        F.col("event.temperature"),
        F.col("event.battery"),
    )


def normalise(raw: DataFrame) -> DataFrame:
    """Typed fields of file-borne readings; rescued content is kept."""
    numbers = ["temperature", "humidity", "pressure", "battery", "lat", "lon"]
    return raw.select(
        F.col("deviceId").cast("string").alias("deviceId"),
        parse_event_time("ts").alias("local_ts"),
        *[F.col(c).try_cast("double").alias(c) for c in numbers],
        F.col("status").cast("string").alias("status"),
        F.current_timestamp().alias("server_ts_utc"),
        "_rescued_data",
    )


def device_summary(readings: DataFrame, size: str = WINDOW) -> DataFrame:
    """Statistics per device and tumbling window. First and last readings are taken by
    event time, so the result does not depend on arrival order; readings that share the
    last timestamp are settled by value."""
    at_end = F.struct("event_timestamp", "temperature", "battery")
    return (
        readings.groupBy("deviceId", F.window("event_timestamp", size))
        .agg(
            F.count(F.lit(1)).alias("message_count"),
            F.avg("temperature").alias("avg_temperature"),
            F.avg("battery").alias("avg_battery"),
            F.min("temperature").alias("min_temperature"),
            F.max("temperature").alias("max_temperature"),
            F.min("battery").alias("min_battery"),
            F.max("battery").alias("max_battery"),
            F.sum("temperature").alias("temperature_sum"),
            F.sum("battery").alias("battery_sum"),
            F.max(at_end).alias("at_end"),
        )
        .select(
            "deviceId",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "message_count",
            "avg_temperature",
            "avg_battery",
            "min_temperature",
            "max_temperature",
            "min_battery",
            "max_battery",
            F.col("at_end.temperature").alias("last_temperature"),
            F.col("at_end.battery").alias("last_battery"),
            (F.col("max_temperature") - F.col("min_temperature")).alias("temperature_range"),
            (F.col("max_battery") - F.col("min_battery")).alias("battery_range"),
        )
    )


def device_alerts(readings: DataFrame, battery_full: float = 100.0) -> DataFrame:
    """Rows that break a limit, with text and severity; keeps no state."""
    kind = alert_type("temperature", "battery", battery_full)
    return (
        readings.withColumn("alert_type", kind)
        .where("alert_type <> 'NORMAL'")
        .select(
            "deviceId",
            "event_timestamp",
            "temperature",
            "battery",
            "alert_type",
            alert_message("alert_type", "temperature", "battery").alias("alert_message"),
            alert_severity("alert_type").alias("severity"),
        )
    )


def with_lateness(readings: DataFrame, column: str = "event_timestamp", delay: str = LATENESS) -> DataFrame:
    return readings.withWatermark(column, delay)
