"""JSON list endpoints as Spark data sources: one task per page, or per range of numbered pages."""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from stratalake.sources.files import RESCUED, rescue_json


class Page(InputPartition):
    def __init__(self, url: str):
        self.url = url


class RestPagesReader(DataSourceReader):
    def __init__(self, options):
        self.urls = json.loads(options["urls"])
        self.timeout = float(options.get("timeout", "10"))
        self.on_error = options.get("on_error", "fail")

    def partitions(self):
        return [Page(u) for u in self.urls]

    def read(self, partition):
        try:
            with urllib.request.urlopen(partition.url, timeout=self.timeout) as answer:
                records = json.loads(answer.read())
        except Exception:
            if self.on_error == "fail":
                raise
            return
        stamp = datetime.now(timezone.utc).isoformat()
        for record in records:
            yield json.dumps(record), stamp


class RestPages(DataSource):
    """`option("urls", json list)`; yields each record as JSON text with its fetch time.

    `on_error` = `fail` (the default: the job fails after Spark's task retries) or `empty`
    (a failed page yields nothing).
    """

    @classmethod
    def name(cls):
        return "rest_pages"

    def schema(self):
        return "record STRING, query_timestamp STRING"

    def reader(self, schema):
        return RestPagesReader(self.options)


def pages(spark: SparkSession, urls: list[str], schema: T.StructType, on_error: str = "fail") -> DataFrame:
    """Records of all pages, parsed with an explicit schema."""
    spark.dataSource.register(RestPages)
    raw = spark.read.format("rest_pages").option("urls", json.dumps(urls)).option("on_error", on_error).load()
    return raw.select(F.from_json("record", schema).alias("r"), "query_timestamp").select("r.*", "query_timestamp")


class Pages(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


def fetch(url: str, timeout: float, retries: int, wait: float, opener: Callable = urllib.request.urlopen):
    """The JSON of a page. A failure is tried again `retries` times, each time after twice the wait."""
    for left in range(retries, -1, -1):
        try:
            with opener(url, timeout=timeout) as answer:
                return json.loads(answer.read())
        except Exception:
            if not left:
                raise
            time.sleep(wait)
            wait *= 2


class NumberedPagesReader(DataSourceReader):
    def __init__(self, options):
        self.url = options["url"]
        self.first = int(options.get("first", "1"))
        self.last = int(options["last"]) if "last" in options else None
        self.total, self.records = options.get("total", "total_pages"), options.get("records", "data")
        self.per_task = max(1, int(options.get("pages_per_task", "1")))
        self.timeout, self.retries, self.wait = float(options.get("timeout", "10")), int(options.get("retries", "3")), float(options.get("wait", "0.5"))

    def _page(self, number: int):
        return fetch(self.url.replace("{page}", str(number)), self.timeout, self.retries, self.wait)

    def partitions(self):
        last = self.last
        if last is None:  # the first page tells how many there are
            last = self.first + int(self._page(self.first)[self.total]) - 1
        return [Pages(a, min(a + self.per_task - 1, last)) for a in range(self.first, last + 1, self.per_task)] or [Pages(1, 0)]

    def read(self, partition):
        for number in range(partition.first, partition.last + 1):
            page = self._page(number)
            stamp = datetime.now(timezone.utc).isoformat()
            for position, record in enumerate(page if isinstance(page, list) else page[self.records] or []):
                yield number, position, json.dumps(record), stamp


class NumberedPages(DataSource):
    """Pages `first` to `last` of `url`, which holds `{page}`; a record per row, as JSON text.

    Without `last` the first page is asked for the number of pages (its field `total`). A page is
    a list or an object with the list in `records`. Each task reads `pages_per_task` pages, one
    after the other, each with `retries` repeats; a page that still fails, fails the job.
    """

    @classmethod
    def name(cls):
        return "numbered_pages"

    def schema(self):
        return "page INT, position INT, record STRING, query_timestamp STRING"

    def reader(self, schema):
        return NumberedPagesReader(self.options)


def numbered_pages(spark: SparkSession, url: str, schema: T.StructType, **options) -> DataFrame:
    """Records of all pages with an explicit schema, by name: fields that a page lacks are NULL,
    and what it has beyond the schema, or of another type, is JSON in `_rescued_data`."""
    spark.dataSource.register(NumberedPages)
    raw = spark.read.format("numbered_pages").option("url", url).options(**options).load()
    return rescue_json(raw, "record", schema).select("page", "position", *schema.fieldNames(), RESCUED, "query_timestamp")


def flatten_users(users: DataFrame) -> DataFrame:
    return users.select(
        F.col("id").alias("user_id"),
        "name",
        "username",
        "email",
        "phone",
        F.col("address.city").alias("city"),
        F.col("address.geo.lat").alias("latitude"),
        F.col("address.geo.lng").alias("longitude"),
        F.col("company.name").alias("company_name"),
    )


def flatten_posts(posts: DataFrame) -> DataFrame:
    return posts.select(
        F.col("id").alias("post_id"), F.col("userId").alias("user_id"), "title", F.col("body").alias("content")
    )


def posts_with_authors(posts: DataFrame, users: DataFrame) -> DataFrame:
    p, u = posts.alias("p"), users.alias("u")
    return p.join(u, F.col("p.user_id") == F.col("u.user_id")).select(
        "p.post_id", "p.title", F.col("u.name").alias("author_name"), "u.company_name", "u.city"
    )


def create_authors_view(spark: SparkSession, view: str, posts: str, users: str) -> None:
    """The same join as a stored view over two tables."""
    spark.sql(
        f"""CREATE OR REPLACE VIEW {view} AS
            SELECT p.post_id, p.title, u.name AS author_name, u.company_name, u.city
            FROM {posts} p JOIN {users} u ON p.user_id = u.user_id"""
    )
