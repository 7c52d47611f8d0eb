"""Starting, finishing and watching streaming queries; order and change streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratalake.operators.keyed import KeyedParquet
from stratalake.operators.quality import expect_all_or_fail
from stratalake.operators.sinks import add_bronze_audit_cols
from stratalake.plans.medallion import checked_customers, checked_orders
from stratalake.plans.sales_metrics import geographic_sales
from stratalake.sources import files

ORDER_LATENESS = "1 day"
FILES_PER_BATCH = 1000
#: Folders of a load; names that no data column has.
FEED, LOAD = "__feed", "__load"


def append_to_path(
    stream: DataFrame, path: str, checkpoint: str, name: str | None = None, available_now: bool = False
) -> StreamingQuery:
    """Append to Parquet files. The sink's own log makes a restarted batch write once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def append_to_table(
    stream: DataFrame, table: str, checkpoint: str, name: str | None = None, available_now: bool = False
) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.toTable(table)


def drain(stream: DataFrame, path: str, checkpoint: str, name: str | None = None) -> DataFrame:
    """Process everything available, then return the written rows."""
    query = append_to_path(stream, path, checkpoint, name, available_now=True)
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def load_csv(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    schema: T.StructType | None = None,
    store: str | None = None,
    rescue: bool = False,
    audit: bool = False,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """Load each CSV file of a folder exactly once, columns by the header of the file.

    With a `schema` the columns are fixed; with a `store` they are inferred, and the feed
    may grow new ones. A micro-batch of a feed, which its checkpoint tells by the id of the stream,
    writes a folder of its own, and a repeated one replaces that. Any number of feeds, or a feed that
    starts again with a new checkpoint, may load into one `out`. The driver knows the file names of one
    micro-batch at a time.
    """
    feed: list[str] = []

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        names = sorted(r[0] for r in batch.distinct().collect())  # at most `files_per_batch`
        if not names:
            return
        if not feed:
            feed.append(session.read.schema("id STRING").json(f"{checkpoint}/metadata").first().id)
        columns = schema if schema is not None else files.feed_schema(session, names, store)
        rows = files.csv_by_name(session, names, columns, rescue)
        rows = add_bronze_audit_cols(rows) if audit else rows
        rows.drop("_metadata").write.mode("overwrite").parquet(f"{out}/{FEED}={feed[0]}/{LOAD}={batch_id}")

    stream = files.stream_file_names(spark, path, files_per_batch)
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.option("mergeSchema", "true").parquet(out).drop(FEED, LOAD)


def copy_into(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Load each source file exactly once, however often it is called."""
    return drain(stream, path, checkpoint)


def active_queries(spark: SparkSession) -> list[dict]:
    return [
        {"name": q.name, "id": str(q.id), "status": q.status["message"], "batches": len(q.recentProgress)}
        for q in spark.streams.active
    ]


# -- dedup -----------------------------------------------------------------


def drop_duplicates_forever(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Every key once. The state keeps every key ever seen; use it only for key sets that
    stay small, else the bounded variant."""
    return stream.dropDuplicates(keys)


def drop_duplicates_within(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Copies that arrive within the delay are dropped; state older than that is freed."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


# -- orders ----------------------------------------------------------------


def orders_stream(
    orders: DataFrame, observe: str | None = None, delay: str | None = None, arrival: str = "arrived_at"
) -> DataFrame:
    """Checked orders, the first copy of each, whatever its date or batch.

    The state holds every order id: run it with `session.LARGE_STATE`. With `delay`, copies
    are only dropped within that span of the `arrival` column, the time at which a row
    reached the feed; it never goes back, so no first copy is late.
    """
    dated = orders.withColumn("order_date", F.to_timestamp("order_date"))
    if delay is None:
        unique = drop_duplicates_forever(dated, ["order_id"])
    else:
        unique = drop_duplicates_within(dated, ["order_id"], arrival, delay)
    return checked_orders(unique, observe)


def customers_stream(customers: DataFrame, as_of: Column, observe: str | None = None) -> DataFrame:
    return checked_customers(drop_duplicates_forever(customers, ["customer_id"]), as_of, observe)


def geographic_stream(orders: DataFrame, customers: DataFrame, delay: str = ORDER_LATENESS) -> DataFrame:
    """Order stream joined with the customer table and closed per 30-day window. Pass the
    customers as a catalog table: it is then listed anew for every micro-batch."""
    return geographic_sales(orders.withWatermark("order_date", delay), customers)


# -- change feed -----------------------------------------------------------


def change_stream(
    changes: DataFrame,
    target: KeyedParquet,
    sequence_by: str,
    checkpoint: str,
    rules: dict[str, str] | None = None,
    except_columns: list[str] = (),
    name: str = "changes",
) -> StreamingQuery:
    """Apply a change feed, keeping the newest row per key.

    A micro-batch rewrites only the key buckets it touches. The highest sequence wins, so a
    batch that is replayed or comes late or from another feed does no harm. A broken rule
    fails the batch before anything is stored. The sequence column is always kept in the target: it
    is what later batches are compared with (drop it with `current_rows`).
    """
    drop = [c for c in except_columns if c != sequence_by]

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = expect_all_or_fail(batch, rules) if rules else batch
        target.apply_changes(rows.drop(*drop), sequence_by)

    return (
        changes.writeStream.queryName(name)
        .foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_rows(target: KeyedParquet, except_columns: list[str] = ()) -> DataFrame:
    return target.read().drop(*except_columns)
