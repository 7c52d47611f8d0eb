"""Numbered pages: planning, retries, schemas that differ by page, failures."""

import io
import json

import pytest
from pyspark.errors import PythonException
from pyspark.sql import types as T

from stratalake.sources import rest

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])


def write_pages(folder, pages, envelope=True):
    for i, records in enumerate(pages, 1):
        body = {"page": i, "total_pages": len(pages), "data": records} if envelope else records
        (folder / f"p{i}.json").write_text(json.dumps(body))
    return f"file://{folder}/p{{page}}.json"


def test_pages_are_read_by_range(spark, tmp_path):
    url = write_pages(tmp_path, [[{"id": 10 * p + i, "name": f"n{i}"} for i in range(3)] for p in range(1, 8)])
    df = rest.numbered_pages(spark, url, SCHEMA, pages_per_task="3")
    rows = df.orderBy("page", "position").collect()
    assert [(r.page, r.position, r.id, r.name) for r in rows] == [(p, i, 10 * p + i, f"n{i}") for p in range(1, 8) for i in range(3)]
    assert df.rdd.getNumPartitions() == 3
    parts = rest.NumberedPagesReader({"url": url, "pages_per_task": "3"}).partitions()
    assert [(p.first, p.last) for p in parts] == [(1, 3), (4, 6), (7, 7)]
    assert rest.numbered_pages(spark, url, SCHEMA, first="2", last="3").count() == 6


def test_pages_with_other_fields(spark, tmp_path):
    url = write_pages(tmp_path, [[{"id": 1, "name": "a"}], [{"id": 2}], [{"name": "c", "id": "x", "more": [1]}], []], envelope=False)
    rows = rest.numbered_pages(spark, url, SCHEMA, last="4").orderBy("page").collect()
    assert [(r.id, r.name) for r in rows] == [(1, "a"), (2, None), (None, "c")]
    assert rows[0]._rescued_data is None and json.loads(rows[2]._rescued_data) == {"id": "x", "more": "[1]"}


def test_no_pages(spark, tmp_path):
    (tmp_path / "p1.json").write_text(json.dumps({"total_pages": 0, "data": []}))
    assert rest.numbered_pages(spark, f"file://{tmp_path}/p{{page}}.json", SCHEMA).count() == 0


def test_a_missing_page_fails_the_job(spark, tmp_path):
    url = write_pages(tmp_path, [[{"id": 1}], [{"id": 2}], [{"id": 3}]])
    (tmp_path / "p2.json").unlink()
    with pytest.raises(PythonException, match="p2.json"):
        rest.numbered_pages(spark, url, SCHEMA, retries="1", wait="0.01").collect()


def test_retries():
    asked = []

    def opener(url, timeout):
        asked.append(url)
        if len(asked) < 3:
            raise OSError("busy")
        return io.BytesIO(b"[1]")

    assert rest.fetch("u", 1, 2, 0.0, opener) == [1] and len(asked) == 3
    asked.clear()
    with pytest.raises(OSError):
        rest.fetch("u", 1, 1, 0.0, opener)
    assert len(asked) == 2


def test_each_page_of_the_query_is_fetched_once(spark, path, monkeypatch):
    from stratalake.queries import lookups

    orders = spark.range(900).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "id / 4 AS o_totalprice", "IF(id % 5 = 0, NULL, 'p\u00e9\"') AS o_orderpriority")
    orders.write.parquet(f"{path}/orders.parquet")
    seen, read = spark.sparkContext.accumulator(0), rest.numbered_pages

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def numbered_pages(*args, **options):
        found = read(*args, **options)
        return found.mapInArrow(counted, found.schema)

    monkeypatch.setattr(rest, "numbered_pages", numbered_pages)
    rows = lookups.src_rest_pages(spark, path).orderBy("id").collect()
    assert [(r.id, r.customer, r.total, r.priority, r.page) for r in rows] == [(i, i % 7, i / 4, None if i % 5 == 0 else 'p\u00e9"', i // 200 + 1) for i in range(900)]
    assert all(r.one_task_per_range for r in rows) and seen.value == 900
