"""Message-bus streams with the columns `body, enqueuedTime, partition`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.schemas import BUS_ENVELOPE


def bus_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **options: str) -> DataFrame:
    """A topic through Spark's Kafka source (needs its connector on the class path)."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
    )
    return raw.select(
        F.col("value").alias("body"),
        F.col("timestamp").alias("enqueuedTime"),
        F.col("partition").cast("string").alias("partition"),
    )


def captured_stream(spark: SparkSession, path: str) -> DataFrame:
    """The same envelope from a folder of captured messages (Parquet)."""
    return spark.readStream.schema(BUS_ENVELOPE).parquet(path)
