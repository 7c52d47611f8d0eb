"""Registered queries: features at a point in time, nearest vectors, erasure, numbered pages."""

from __future__ import annotations

import os
import urllib.parse
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.filesystem import Files
from stratalake.operators import erasure, vectors
from stratalake.operators.asof import as_of_join
from stratalake.operators.ranges import add_row_number
from stratalake.queries import entities as e
from stratalake.queries.registry import query
from stratalake.session import scratch_path
from stratalake.sources import rest

# -- features at a point in time -------------------------------------------

# Shipments, and what was known of their customer's orders by then.
SHIPMENTS = """ship AS (SELECT l_orderkey, l_linenumber, o_custkey, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  hist AS (SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice, count(*) OVER w AS orders_to_date,
      sum(round(o_totalprice * 100)) OVER w AS spent_to_date FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)),
  newest AS (SELECT * FROM hist QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1)"""


def _point_in_time_sql(condition: str, age: str = "") -> str:
    names = ("last_orderkey", "last_amount", "orders_to_date", "spent_to_date")
    sources = ("o_orderkey", "o_totalprice", "orders_to_date", "spent_to_date")
    limited = [f"CASE WHEN n.o_orderdate >= s.l_shipdate - {age} THEN n.{c} END" if age else f"n.{c}" for c in sources]
    columns = ", ".join(f"{c} AS {n}" for c, n in zip(limited, names))
    return f"""WITH {SHIPMENTS} SELECT s.*, {columns} FROM ship s ASOF LEFT JOIN newest n
      ON s.o_custkey = n.o_custkey AND {condition}"""


def _shipments(spark, sf) -> tuple[DataFrame, DataFrame]:
    orders = e.load(spark, sf, "orders")
    lines = e.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    ships = lines.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    so_far = "OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)"
    history = orders.selectExpr(
        "o_custkey",
        "o_orderdate",
        "o_orderkey AS last_orderkey",
        "o_totalprice AS last_amount",
        f"count(*) {so_far} AS orders_to_date",
        f"sum(round(o_totalprice * 100)) {so_far} AS spent_to_date",
    )
    return ships.select("l_orderkey", "l_linenumber", "o_custkey", "l_shipdate"), history


FEATURES = ["last_orderkey", "last_amount", "orders_to_date", "spent_to_date"]


@query("feat_point_in_time", _point_in_time_sql("s.l_shipdate >= n.o_orderdate"))
def feat_point_in_time(spark, sf):
    ships, history = _shipments(spark, sf)
    return as_of_join(ships, history, ["o_custkey"], "l_shipdate", "o_orderdate", FEATURES, ["last_orderkey"])


@query("feat_point_in_time_hot", _point_in_time_sql("s.l_shipdate > n.o_orderdate", "INTERVAL 60 DAYS"))
def feat_point_in_time_hot(spark, sf):
    """Orders before the day of shipment and at most sixty days old; many customers are split."""
    ships, history = _shipments(spark, sf)
    return as_of_join(
        ships, history, ["o_custkey"], "l_shipdate", "o_orderdate", FEATURES, ["last_orderkey"],
        max_age=F.expr("INTERVAL 60 DAYS"), strictly_before=True, hot_rows=60,
    )


# -- nearest vectors -------------------------------------------------------

NEIGHBOURS = 10


@query(
    "vec_topk",
    f"""WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
      p AS (SELECT q.vec_id AS query_id, v.vec_id AS id, round(list_cosine_similarity(q.vec, v.vec), 9) AS similarity
        FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0)
      SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank, id, round(similarity, 6) AS similarity
      FROM p QUALIFY rank <= {NEIGHBOURS}""",
)
def vec_topk(spark, sf):
    """Every hundredth vector against all."""
    rows = e.load(spark, sf, "embeddings")
    found = vectors.exact_top_k(rows, rows.where("vec_id % 100 = 0"), NEIGHBOURS, "vec_id", "embedding")
    return found.withColumn("similarity", F.round("similarity", 6))


@query(
    "vec_topk_lsh",
    f"""SELECT count(*) AS queries, count(*) * {NEIGHBOURS} AS neighbours, TRUE AS recall_reached, TRUE AS similarities_agree
        FROM embeddings WHERE vec_id % 100 = 0""",
)
def vec_topk_lsh(spark, sf):
    """The hashed search: facts against the exact one."""
    rows = e.load(spark, sf, "embeddings")
    asked = rows.where("vec_id % 100 = 0")
    path = scratch_path(spark, "neighbours")
    vectors.lsh_top_k(rows, asked, NEIGHBOURS, "vec_id", "embedding").write.parquet(path)
    found = spark.read.parquet(path)
    exact = vectors.exact_top_k(rows, asked, NEIGHBOURS, "vec_id", "embedding")
    both = exact.join(found.select("query_id", "id", F.col("similarity").alias("other")), ["query_id", "id"], "left")
    return both.agg(
        F.countDistinct("query_id").alias("queries"),
        F.count(F.lit(1)).alias("neighbours"),
        (F.count("other") >= 0.9 * F.count(F.lit(1))).alias("recall_reached"),
        F.every(F.coalesce(F.abs(F.col("similarity") - F.col("other")) < 1e-8, F.lit(True))).alias("similarities_agree"),
    )


# -- erasure ---------------------------------------------------------------


@query(
    "gov_erase_subject",
    """WITH s AS (SELECT c_custkey FROM customer WHERE c_acctbal IN (SELECT min(c_acctbal) FROM customer UNION ALL SELECT max(c_acctbal) FROM customer)),
      so AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (FROM s)),
      t AS (SELECT 'customer' AS table_name, c_custkey IN (FROM s) AS gone, round(c_acctbal * 100) AS amount FROM customer
        UNION ALL SELECT 'lineitem', l_orderkey IN (FROM so), round(l_extendedprice * 100) FROM lineitem
        UNION ALL SELECT 'orders', o_custkey IN (FROM s), round(o_totalprice * 100) FROM orders)
      SELECT table_name, count(*) FILTER (WHERE NOT gone) AS rows_left, sum(amount) FILTER (WHERE NOT gone) AS amount_left,
        count(*) FILTER (WHERE gone) AS rows_erased, TRUE AS others_untouched, TRUE AS some_untouched FROM t GROUP BY table_name""",
)
def gov_erase_subject(spark, sf):
    """Two customers are erased from three tables; files without them keep their names."""
    base, files = scratch_path(spark, "erase"), Files(spark)
    c = e.load(spark, sf, "customer")
    ends = c.agg(F.min("c_acctbal"), F.max("c_acctbal")).first()
    subjects = c.where(F.col("c_acctbal").isin(*ends)).select("c_custkey")
    orders = e.load(spark, sf, "orders")
    theirs = orders.join(subjects, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", F.col("o_orderkey").alias("l_orderkey"))
    tables = {
        "customer": ("c_custkey", subjects, "c_acctbal"),
        "orders": ("o_custkey", subjects.select(F.col("c_custkey").alias("o_custkey")), "o_totalprice"),
        "lineitem": ("l_orderkey", theirs.select("l_orderkey"), "l_extendedprice"),
    }
    out = None
    for name, (key, gone, amount) in tables.items():
        root = f"{base}/{name}"
        # lines follow their order number, so an order's lines are in one file
        e.load(spark, sf, name).repartitionByRange(32, key).write.parquet(root)
        before = set(files.below(root))
        held = {files.plain(r.file) for r in erasure.files_holding(spark.read.parquet(root), key, gone).collect()}
        report = erasure.erase(spark, root, key, gone)
        kept = {n for n in before if files.qualified(f"{root}/{n}") not in held}
        found = spark.read.parquet(root).agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("rows_left"),
            F.sum(e.minor(amount)).alias("amount_left"),
            F.lit(report.rows_erased).cast("bigint").alias("rows_erased"),
            F.lit(set(files.below(root)) & before == kept).alias("others_untouched"),
            F.lit(report.files_untouched > 0).alias("some_untouched"),
        )
        out = found if out is None else out.unionByName(found)
    return out


# -- numbered pages --------------------------------------------------------

PAGE_ROWS = 200
ORDER_RECORDS = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("customer", T.LongType()), T.StructField("total", T.DoubleType()), T.StructField("priority", T.StringType())]
)


def _capture_pages(orders: DataFrame, folder: str) -> int:
    """A service's answers, one file per page, written by tasks; a repeated task writes the same."""
    last = -(-orders.count() // PAGE_ROWS)
    numbered = add_row_number(orders, ["o_orderkey"], "n").withColumn("page", F.expr(f"(n - 1) div {PAGE_ROWS} + 1"))
    record = F.struct(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"), F.col("o_totalprice").alias("total"), F.col("o_orderpriority").alias("priority"))
    pages = numbered.groupBy("page").agg(F.to_json(F.sort_array(F.collect_list(record))).alias("data"))  # PAGE_ROWS rows each

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = (fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder))
        system.create_dir(place)
        for batch in batches:
            for page, data in zip(*[c.to_pylist() for c in batch.columns]):
                with system.open_output_stream(f"{place}/page-{page}.json") as out:
                    out.write(f'{{"page": {page}, "total_pages": {last}, "data": {data}}}'.encode())
            yield batch.select(["page"])

    return pages.select("page", "data").mapInArrow(write, "page long").count()


@query(
    "src_rest_pages",
    f"""SELECT o_orderkey AS id, o_custkey AS customer, o_totalprice AS total, o_orderpriority AS priority,
          CAST(ceil(row_number() OVER (ORDER BY o_orderkey) / {PAGE_ROWS}.0) AS INTEGER) AS page,
          TRUE AS one_task_per_range FROM orders""",
)
def src_rest_pages(spark, sf):
    """Orders as numbered pages of a service, read four pages a task."""
    base = scratch_path(spark, "pages")
    folder = base.replace("file:/", "file:///") if base.startswith("file:/") and not base.startswith("file://") else base
    pages = _capture_pages(e.load(spark, sf, "orders"), folder)
    url = folder if "://" in folder else "file://" + urllib.parse.quote(os.path.abspath(folder))
    found = rest.numbered_pages(spark, url + "/page-{page}.json", ORDER_RECORDS, pages_per_task="4", timeout="60")
    # Stored with the task that read it: every page is fetched once.
    stored = found.select(*ORDER_RECORDS.fieldNames(), "page", F.spark_partition_id().alias("task"))
    stored.write.parquet(f"{base}-read")
    read = spark.read.schema(stored.schema).parquet(f"{base}-read")
    planned = read.groupBy("task").agg(F.min("page").alias("a"), F.max("page").alias("b"))
    ranges = planned.agg(F.count(F.lit(1)), F.every((F.col("a") % 4 == 1) & (F.col("b") < F.col("a") + 4))).first()
    return read.select(*ORDER_RECORDS.fieldNames(), "page", F.lit(ranges[0] == -(-pages // 4) and bool(ranges[1])).alias("one_task_per_range"))
