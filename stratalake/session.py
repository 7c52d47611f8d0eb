"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Run-time re-planning: coalesce small shuffle partitions, split skewed ones, and let
#: a join become a broadcast join once the measured size of a side allows it.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
}

#: For streams whose state outgrows executor memory (endless dedup, many open windows).
LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

BASE = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "stratalake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with adaptive execution on; `extra` wins over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**BASE, **ADAPTIVE}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_adaptive(spark: SparkSession, **overrides: str) -> dict[str, str]:
    """Set the adaptive options on a running session and return what is in force."""
    wanted = {**ADAPTIVE, **overrides}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    return {key: spark.conf.get(key) for key in wanted}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from `spark.checkpoint.dir`.

    Only a local session that names none (tests) gets a temporary folder, which is then
    written back to the session so that later calls agree.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("stratalake.shared.dir", None)
    if base is None:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="stratalake-")
        spark.conf.set("stratalake.shared.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def shuffle_width(spark: SparkSession) -> int:
    """The configured number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
