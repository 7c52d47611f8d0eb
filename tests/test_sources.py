import json
from pathlib import Path

import pytest
from support_core import plan, rows
from pyspark.sql import functions as F

from stratalake.operators import sinks
from stratalake.schemas import ORDERS, REST_POSTS, REST_USERS, TABLE_SCHEMAS, columns, schema_for
from stratalake.sources import files, jdbc, rest, synthetic
from stratalake.streaming import jobs

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def write(path, text):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(text)


def test_schema_registry():
    assert list(TABLE_SCHEMAS) == ["customers", "orders", "order_items", "products"]
    assert schema_for("orders") == ORDERS
    with pytest.raises(ValueError):
        schema_for("nope")


def test_bronze_csv_with_dirty_values(spark, path):
    write(f"{path}/order_items/2024/01/a.csv", "order_item_id,order_id,product_id,quantity,unit_price\n1,o1,p1,2,9.5\n2,o1,p2,two,x\n")
    write(f"{path}/order_items/2024/02/b.csv", "order_item_id,order_id,product_id,quantity,unit_price\n3,o2,p1,1,1\n")
    got = files.load_bronze(spark, "order_items", path)
    assert rows(got.select("order_item_id", "quantity", "unit_price"), "order_item_id") == [("1", 2, 9.5), ("2", None, None), ("3", 1, 1.0)]
    assert got.select("source_file").distinct().count() == 2


def test_csv_rescue(spark, path):
    write(f"{path}/in/a.csv", "id,n\n1,5\n2,five\n3,6,extra\n")
    got = files.csv_rescued(spark, f"{path}/in", columns("id INT, n INT"))
    by_id = {r["id"]: r["_rescued_data"] for r in got.collect()}
    assert by_id == {1: None, 2: '{"n":"five"}', 3: "3,6,extra"}


def test_csv_columns_are_found_by_name(spark, path):
    """Moved, missing, unknown, repeated and oddly written columns; an empty file; a space in a name."""
    write(f"{path}/in/a.csv", "id,n,s\n1,5,x\n")
    write(f"{path}/in/b b.csv", "s,id,n\ny,2,6\n")
    write(f"{path}/in/c.csv", '\ufeffN,ID,"more, of it",more,more\n7,3,q,r,t\n')
    write(f"{path}/in/d.csv", "")
    schema = columns("id INT, n INT, s STRING")
    assert rows(files.csv_with_schema(spark, f"{path}/in", schema)) == sorted([(1, 5, "x"), (2, 6, "y"), (3, 7, None)], key=repr)
    held = files.csv_rescued(spark, f"{path}/in", schema).where("id = 3").first()["_rescued_data"]
    assert json.loads(held) == {"more, of it": "q", "more": "r", "more_c4": "t"}


def test_csv_feed_over_deliveries(spark, path):
    """Each delivery once, columns by name, new columns added, chosen types kept."""
    load = lambda: jobs.load_csv(spark, f"{path}/in", f"{path}/out", f"{path}/c", store=f"{path}/schema")
    write(f"{path}/in/a.csv", "id,n\n1,5\n")
    assert rows(load().select("id", "n")) == [(1, 5)]
    write(f"{path}/in/b.csv", "n,id\n6,2\n")
    write(f"{path}/in/c.csv", "extra,id,n\ne,3,seven\n")
    assert rows(load().select("id", "n", "extra")) == sorted([(1, 5, None), (2, 6, None), (3, None, "e")], key=repr)
    assert load().count() == 3


def test_positional_csv_stream_refuses_a_foreign_header(spark, path):
    write(f"{path}/in/a.csv", "n,id\n5,1\n")
    stream = files.stream_csv(spark, f"{path}/in", columns("id INT, n INT"))
    with pytest.raises(Exception, match="reading file"):
        jobs.drain(stream, f"{path}/out", f"{path}/c")


def test_json_rescue(spark, path):
    write(f"{path}/in/a.json", '{"id": 1, "n": 5}\n{"id": 2, "n": "five", "more": true}\nnot json\n{"id": 3, "n": null}\n')
    got = files.json_rescued(spark, f"{path}/in", columns("id INT, n INT"))
    found = {(r["id"], r["n"]): r["_rescued_data"] for r in got.collect()}
    assert found[(1, 5)] is None and found[(3, None)] is None and found[(None, None)] == "not json"
    assert json.loads(found[(2, None)]) == {"n": "five", "more": "true"}


def test_json_arrays_pretty_printed(spark, path):
    write(f"{path}/in/a.json", json.dumps([{"id": 1, "x": 1}, {"id": 2}], indent=2))
    write(f"{path}/in/b.json", json.dumps({"id": 3}, indent=2))
    assert rows(files.json_documents(spark, f"{path}/in", columns("id INT"))) == [(1,), (2,), (3,)]
    write(f"{path}/in/c.json", "broken [")
    got = files.json_rescued(spark, f"{path}/in", columns("id INT"), array_files=True)
    assert rows(got) == sorted([(1, '{"x":"1"}'), (2, None), (3, None), (None, "broken [")], key=repr)


def test_dated_partition(spark, path):
    schema = columns("event_id STRING")
    spark.createDataFrame([("e1",)], schema).write.parquet(f"{path}/date=2024-01-15")
    spark.createDataFrame([], schema).write.parquet(f"{path}/date=2024-01-16")
    assert files.dated_partition(spark, path + "/", "2024-01-15", schema=schema).count() == 1
    for bad in (("", "2024-01-15"), (path, "")):
        with pytest.raises(ValueError):
            files.dated_partition(spark, *bad)
    with pytest.raises(RuntimeError):
        files.dated_partition(spark, path, "2024-01-16", schema=schema)


def test_feed_schema_keeps_types_and_grows(spark, path):
    write(f"{path}/in/a.csv", "id,n\n1,5\n")
    first = files.feed_schema(spark, f"{path}/in", f"{path}/schema")
    write(f"{path}/in/b.csv", "id,n\nx,y\n")
    assert files.feed_schema(spark, f"{path}/in", f"{path}/schema") == first
    assert first.simpleString() == "struct<id:int,n:int>"
    write(f"{path}/in/c.csv", "n,late,id\n1,2.5,3\n")
    assert files.feed_schema(spark, f"{path}/in", f"{path}/schema").simpleString() == "struct<id:int,n:int,late:double>"


def test_drift(spark):
    a, b = spark.createDataFrame([(1,)], "id INT"), spark.createDataFrame([("x", 2)], "extra STRING, id INT")
    assert rows(files.drifting(a, b)) == [(1, None), (2, "x")]


def test_partition_and_column_pruning(spark, path):
    df = spark.range(100).select("id", (F.col("id") % 2 + 2023).alias("year"), F.lit("wide").alias("unused"))
    sinks.write_partitioned(df, f"{path}/t", "year")
    text = plan(files.partitioned(spark, f"{path}/t", year=2023).where("id > 50").select("id"))
    assert "PartitionFilters: [isnotnull(year" in text and "PushedFilters: [IsNotNull(id), GreaterThan(id,50)]" in text
    assert "ReadSchema: struct<id:bigint>" in text


def test_replace_partitions_keeps_the_others(spark, path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v INT, d STRING")
    sinks.replace_partitions(df, f"{path}/t", "d")
    sinks.replace_partitions(spark.createDataFrame([(9, "b")], "v INT, d STRING"), f"{path}/t", "d")
    assert rows(spark.read.parquet(f"{path}/t")) == [(1, "a"), (9, "b")]


# -- database (embedded, in this process only) -----------------------------


@pytest.fixture(scope="module")
def db(spark):
    url = "jdbc:derby:memory:strata;create=true"
    orders = spark.range(1, 101).select(
        F.col("id").cast("int").alias("ORDER_ID"),
        (F.col("id") * 1.5).cast("decimal(18,2)").alias("TOTAL_AMOUNT"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("UPDATED_DATE"),
    )
    orders.write.mode("overwrite").jdbc(url, "ORDERS", properties=DERBY)
    return url


def test_jdbc_table_whole_and_split(spark, db):
    whole = jdbc.table(spark, db, "ORDERS", DERBY)
    split = jdbc.table(spark, db, "ORDERS", DERBY, split_on="ORDER_ID", parts=4)
    assert rows(whole) == rows(split) and whole.count() == 100
    sizes = split.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4


def test_jdbc_query_and_changes(spark, db):
    from datetime import datetime

    assert jdbc.query(spark, db, "SELECT ORDER_ID FROM ORDERS WHERE ORDER_ID > 95", properties=DERBY).count() == 5
    changed = jdbc.changed_since(spark, db, "ORDERS", "UPDATED_DATE", datetime(2024, 1, 5), DERBY)
    assert changed.count() == 4 and changed.agg(F.min("ORDER_ID")).first()[0] == 97


# -- paged JSON ------------------------------------------------------------

USERS = [
    {"id": 1, "name": "Ann", "username": "ann", "email": "a@x", "phone": "1",
     "address": {"city": "Rome", "geo": {"lat": "1.5", "lng": "-2"}}, "company": {"name": "Acme"}},
    {"id": 2, "name": "Bo", "username": "bo", "email": "b@x", "phone": "2", "address": None, "company": None},
]


def test_rest_pages(spark, path):
    write(f"{path}/users1.json", json.dumps(USERS[:1]))
    write(f"{path}/users2.json", json.dumps(USERS[1:]))
    write(f"{path}/posts.json", json.dumps([{"id": 7, "userId": 1, "title": "t", "body": "b"}]))
    urls = [f"file://{path}/users{i}.json" for i in (1, 2)]
    users = rest.pages(spark, urls, REST_USERS)
    assert users.rdd.getNumPartitions() == 2 and users.where("query_timestamp IS NULL").isEmpty()
    flat = rest.flatten_users(users)
    assert rows(flat.select("user_id", "city", "latitude", "company_name")) == [(1, "Rome", "1.5", "Acme"), (2, None, None, None)]
    posts = rest.flatten_posts(rest.pages(spark, [f"file://{path}/posts.json"], REST_POSTS))
    assert rows(rest.posts_with_authors(posts, flat)) == [(7, "t", "Ann", "Acme", "Rome")]


def test_rest_failures(spark, path):
    gone = [f"file://{path}/missing.json"]
    assert rest.pages(spark, gone, REST_POSTS, on_error="empty").count() == 0
    with pytest.raises(Exception, match="missing.json"):
        rest.pages(spark, gone, REST_POSTS).count()


# -- generators ------------------------------------------------------------


def test_generators(spark):
    sales = synthetic.sales(synthetic.ids(spark, 5000))
    s = sales.agg(F.min("quantity"), F.max("quantity"), F.countDistinct("region"), F.min("event_date"), F.max("event_date")).first()
    assert (s[0], s[1], s[2]) == (1, 10, 5) and str(s[3]) >= "2022-01-01" and str(s[4]) <= "2023-12-31"
    assert rows(sales) == rows(synthetic.sales(synthetic.ids(spark, 5000)))
    hot = synthetic.skewed(synthetic.ids(spark, 5000)).where("customer_id = 1").count()
    assert 4300 < hot < 4700
    e = synthetic.events(synthetic.ids(spark, 2000)).agg(F.min("value"), F.max("value"), F.max("user_id"), F.max("year")).first()
    assert e[0] >= 10 and e[1] <= 500 and e[2] <= 1000 and e[3] == 2023


# -- tables ----------------------------------------------------------------


def test_write_table_modes(spark, path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS wt")
    name = "spark_catalog.wt.events"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v INT, d STRING")
    for bad in ("events", "wt.events", "a.b.c.d"):
        with pytest.raises(ValueError):
            sinks.write_table(df, bad)
    with pytest.raises(ValueError):
        sinks.write_table(df, name, mode="upsert")
    sinks.write_table(df, name, ["d"])
    sinks.write_table(df, name, ["d"])
    assert spark.table(name).count() == 4
    sinks.write_table(spark.createDataFrame([(3, "c", 1.5)], "v INT, d STRING, extra DOUBLE"), name, ["d"])
    assert spark.table(name).count() == 5 and spark.table(name).where("extra = 1.5").count() == 1
    sinks.write_table(spark.createDataFrame([(9, "a")], "v INT, d STRING"), name, ["d"], mode="replace")
    assert rows(spark.table(name).where("d = 'a'").select("v")) == [(9,)] and spark.table(name).count() == 4
    sinks.write_table(df.select("v"), name, mode="overwrite")
    assert spark.table(name).columns == ["v"]
    sinks.write_table(df, name, mode="merge", keys=["v"], merge_path=f"{path}/m")
    sinks.write_table(df.withColumn("d", F.lit("z")), name, mode="merge", keys=["v"], merge_path=f"{path}/m")
    with pytest.raises(RuntimeError):
        sinks.write_table(df.union(df), name, mode="merge", keys=["v"], merge_path=f"{path}/m")


def test_column_comments(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS ddl")
    sinks.create_table(spark, "ddl.customers", {"customer_id": ("STRING", "key")}, "people")
    sinks.create_table(spark, "ddl.customers", {"customer_id": ("STRING", "key")}, "people")
    assert spark.catalog.listColumns("ddl.customers")[0].description == "key"


def test_audit_columns(spark):
    df = spark.createDataFrame([("ORD001", "C001", 100.0), ("ORD002", "C002", 150.0)], "order_id STRING, customer_id STRING, amount DOUBLE")
    out = sinks.add_silver_audit_cols(df)
    assert out.columns == [*df.columns, "silver_loaded_ts_utc"] and out.where("silver_loaded_ts_utc IS NULL").isEmpty()
    assert sinks.add_silver_audit_cols(df.where("FALSE")).count() == 0


# -- headers and feeds -----------------------------------------------------


def test_headers_of_many_files_are_read_in_tasks(spark, path, monkeypatch):
    import gzip
    import os

    os.makedirs(f"{path}/a b/é%")
    for i in range(40):
        text = f"id,v{i % 3}\r\n{i},x\r\n" if i % 2 else f"id,v{i % 3}\n{i},x"
        name = f"{path}/a b/é%/part {i}.csv"
        if i % 5 == 0:
            with gzip.open(name + ".gz", "wb") as f:
                f.write(text.encode())
        else:
            write(name, text)
    write(f"{path}/a b/é%/empty.csv", "")
    names = files.listed(spark, f"{path}/a b/*")
    by_driver = files._lines_by_driver(spark, names)
    monkeypatch.setattr(files, "_lines_by_driver", None)  # not used
    found = files.first_lines(spark, names)
    assert len(names) >= 40 and found == by_driver and set(filter(None, found.values())) == {"id,v0", "id,v1", "id,v2"}


def test_two_feeds_and_a_new_checkpoint_load_into_one_target(spark, path):
    import os

    for feed, lines in (("a", "id,v\n1,a\n"), ("b", "v,id\nb,2\n")):
        os.makedirs(f"{path}/{feed}")
        write(f"{path}/{feed}/1.csv", lines)
    schema = columns("id INT, v STRING")
    load = lambda feed, checkpoint: jobs.load_csv(spark, f"{path}/{feed}", f"{path}/out", f"{path}/{checkpoint}", schema=schema, files_per_batch=1)
    for _ in range(2):
        load("a", "ca")
        out = load("b", "cb")
    assert out.columns == ["id", "v"] and rows(out) == [(1, "a"), (2, "b")]
    write(f"{path}/a/2.csv", "id,v\n3,c\n")
    assert rows(load("a", "ca")) == [(1, "a"), (2, "b"), (3, "c")]
    os.makedirs(f"{path}/c")
    write(f"{path}/c/1.csv", "id,v\n4,d\n")
    assert rows(load("c", "new")) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
