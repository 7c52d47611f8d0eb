"""File readers, batch and streaming, with fixed, inferred and drifting schemas."""

from __future__ import annotations

import csv
import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.sinks import add_bronze_audit_cols
from stratalake.schemas import BRONZE_CASTS, RAW_SALES
from stratalake.session import shuffle_width

RESCUED, BROKEN_LINE = "_rescued_data", "__broken_line"
#: Files whose header the driver reads at once; a task of many files reads so many.
HEADER_THREADS, HEADERS_PER_TASK, HEADER_TASKS = 16, 64, 16
ARROW_SCHEMES = ("file", "hdfs", "s3", "gs", "abfs")


def with_rescue_column(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])


def first_lines(spark: SparkSession, names: list[str]) -> dict[str, str | None]:
    """The first line of each file; nothing else is read.

    Many files are opened by tasks, on the file systems that Arrow knows; a few, and those on any
    other file system, by the driver through Hadoop's."""
    if len(names) <= HEADER_THREADS or not all(n.split(":", 1)[0] in ARROW_SCHEMES for n in names):
        return _lines_by_driver(spark, names)
    rows = spark.createDataFrame([(n,) for n in names], "name STRING")
    tasks = min(-(-len(names) // HEADERS_PER_TASK), HEADER_TASKS * shuffle_width(spark))
    found = rows.repartition(tasks).mapInArrow(_lines_in_task, "name STRING, line STRING")
    return {r.name: r.line for r in found.toLocalIterator()}


def _lines_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(_first_line, names), pa.string())], ["name", "line"])


def _first_line(name: str) -> str | None:
    # Hadoop writes file:/a/b
    scheme, rest = name.split(":", 1)
    system, place = fs.FileSystem.from_uri(f"{scheme}:{quote(rest if rest.startswith('//') else '//' + rest)}")
    data = b""
    with system.open_input_stream(place, compression="detect", buffer_size=1 << 16) as stream:
        while b"\n" not in data and b"\r" not in data and (more := stream.read(1 << 16)):
            data += more
    return data.splitlines()[0].decode("utf-8", "replace") if data else None


def _lines_by_driver(spark: SparkSession, names: list[str]) -> dict[str, str | None]:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first(name: str) -> str | None:
        path = jvm.org.apache.hadoop.fs.Path(name)
        stream = path.getFileSystem(conf).open(path)
        codec = codecs.getCodec(path)
        stream = stream if codec is None else codec.createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        try:
            return reader.readLine()
        finally:
            reader.close()

    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        return dict(zip(names, pool.map(first, names)))


def listed(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files behind a path, a pattern or a list of them."""
    names = spark.read.schema("value STRING").text(path).inputFiles()
    return sorted(spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(n)).toString() for n in names)


def header_names(line: str) -> list[str]:
    """Column names of a header line; an empty or repeated name gets its position."""
    names = [n.strip().lstrip("\ufeff") for n in next(csv.reader([line]))]
    seen: set[str] = set()
    for i, n in enumerate(names):
        if not n or n.lower() in seen:
            names[i] = f"{n}_c{i}"
        seen.add(names[i].lower())
    return names


def csv_by_name(spark: SparkSession, path: str | list[str], schema: T.StructType, rescue: bool = False) -> DataFrame:
    """CSV whose columns are found by the header of each file, in any order; `_metadata` last.

    One read per distinct header line. A column that a file lacks is NULL, and so is a value
    that does not fit its type. With `rescue`, unknown columns and values that do not fit are
    kept as JSON in `_rescued_data`, and a line with more or fewer values than its header whole.
    """
    groups: dict[str, list[str]] = {}
    for name, line in first_lines(spark, listed(spark, path)).items():
        if line:
            groups.setdefault(line, []).append(name)
    out = None
    for line, names in sorted(groups.items()):
        found = _csv_of_header(spark, names, header_names(line), schema, rescue)
        out = found if out is None else out.unionByName(found)
    if out is not None:
        return out
    empty = spark.read.schema(with_rescue_column(schema) if rescue else schema).csv(path)
    return empty.where("false").select("*", "_metadata")


def _csv_of_header(spark, names: list[str], header: list[str], schema: T.StructType, rescue: bool) -> DataFrame:
    text = T.StructType([T.StructField(h, T.StringType()) for h in [*header, BROKEN_LINE]])
    options = {"header": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN_LINE, "columnPruning": "false"}
    raw = spark.read.options(**options).schema(text).csv(names)
    here = {h.lower(): F.col(f"`{h}`") for h in header}
    typed = {f.name: here[f.name.lower()].try_cast(f.dataType) for f in schema.fields if f.name.lower() in here}
    columns = [typed.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    if rescue:
        known = {f.name.lower(): f.name for f in schema.fields}
        kept = [
            x
            for h in header
            for x in (
                F.lit(known.get(h.lower(), h)),
                F.when(typed[known[h.lower()]].isNull(), here[h.lower()]) if h.lower() in known else here[h.lower()],
            )
        ]
        odd = F.map_filter(F.create_map(*kept), lambda k, v: v.isNotNull())
        rescued = F.when(F.col(BROKEN_LINE).isNotNull(), F.col(BROKEN_LINE)).when(F.size(odd) > 0, F.to_json(odd))
        columns.append(rescued.alias(RESCUED))
    return raw.select(*columns, "_metadata")


def csv_with_schema(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return csv_by_name(spark, path, schema).drop("_metadata")


def csv_cast(spark: SparkSession, pattern: str, schema: T.StructType) -> DataFrame:
    """Columns by name, cast one by one; a value that does not fit is NULL."""
    return csv_by_name(spark, pattern, schema)


def load_bronze(spark: SparkSession, table: str, base: str) -> DataFrame:
    """CSV two folder levels below the table's staging folder, cast, with audit columns."""
    df = csv_cast(spark, f"{base.rstrip('/')}/{table}/*/*", BRONZE_CASTS[table])
    return add_bronze_audit_cols(df).drop("_metadata")


def json_documents(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Pretty-printed or array JSON files; give a schema to skip the inference pass."""
    reader = spark.read.option("multiLine", "true")
    return (reader.schema(schema) if schema else reader).json(path)


def partitioned(spark: SparkSession, path: str, **equals) -> DataFrame:
    """Partitioned Parquet restricted to partition values; other folders are not listed
    into tasks (PartitionFilters)."""
    df = spark.read.parquet(path)
    for column, value in equals.items():
        df = df.where(F.col(column) == F.lit(value))
    return df


def dated_partition(
    spark: SparkSession, source_path: str, execution_date: str, file_format: str = "parquet",
    schema: T.StructType = RAW_SALES,
) -> DataFrame:
    """The `date=` folder of one day, with a fixed schema.

    ValueError for empty arguments; RuntimeError when the day holds no row, which is found
    by reading one row rather than counting them all.
    """
    if not source_path or not execution_date:
        raise ValueError("source_path and execution_date must be given")
    path = f"{source_path.rstrip('/')}/date={execution_date}/"
    df = spark.read.format(file_format).schema(schema).load(path)
    if df.isEmpty():
        raise RuntimeError(f"no data at {path}")
    return df


def csv_rescued(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a fixed schema, columns by name, and what does not fit in `_rescued_data`."""
    return csv_by_name(spark, path, schema, rescue=True).drop("_metadata")


def rescue_json(lines: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """Typed fields of JSON object text, plus `_rescued_data`: JSON of the fields that are
    unknown or whose value does not fit its type, or the text itself when it is no object."""
    fields = F.from_json(F.col(text), T.MapType(T.StringType(), T.StringType()))
    held = lines.withColumn("__m", fields)
    typed = {f.name: F.col("__m")[f.name].try_cast(f.dataType) for f in schema.fields}

    known = [f.name for f in schema.fields]

    def lost(key, value):
        bad = F.lit(False)
        for f in schema.fields:
            if not isinstance(f.dataType, T.StringType):
                bad = bad | ((key == f.name) & value.isNotNull() & value.try_cast(f.dataType).isNull())
        return ~key.isin(known) | bad

    extra = F.map_filter(F.col("__m"), lost)
    rescued = (
        F.when(F.col("__m").isNull() & F.col(text).isNotNull(), F.col(text))
        .when(F.size(extra) > 0, F.to_json(extra))
    )
    others = [c for c in lines.columns if c != text]
    return held.select(*others, *[c.alias(n) for n, c in typed.items()], rescued.alias(RESCUED))


def json_rescued(spark: SparkSession, path: str, schema: T.StructType, array_files: bool = False) -> DataFrame:
    """JSON with rescue; one object per line, or one array of objects per file."""
    return rescue_json(_json_objects(spark.read, path, array_files), "value", schema)


def _json_objects(reader, path: str, array_files: bool) -> DataFrame:
    if not array_files:
        return reader.schema("value STRING").text(path)
    # a file is one row here: suits landing files of device batches, not bulk exports
    whole = reader.schema("value STRING").text(path, wholetext=True)
    fields = T.MapType(T.StringType(), T.StringType())
    items = F.coalesce(F.from_json("value", T.ArrayType(fields)), F.array(F.from_json("value", fields)))
    # a file that is neither an array nor an object goes on as its own text
    return whole.select(F.explode(items).alias("m"), "value").select(F.coalesce(F.to_json("m"), "value").alias("value"))


def drifting(*frames: DataFrame) -> DataFrame:
    """Batches whose columns grew over time, aligned by name; absent columns are NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def parquet_merged(spark: SparkSession, path: str) -> DataFrame:
    """Parquet whose files have different columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def feed_schema(spark: SparkSession, path: str | list[str], store: str) -> T.StructType:
    """The schema of a CSV feed: inferred from its first files and kept at `store`. When files
    with new column names turn up, those columns are inferred and added at the end; a type
    that was chosen stays."""
    try:
        kept = spark.read.schema("version INT, value STRING").json(store).orderBy(F.desc("version")).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        kept = None
    schema = T.StructType.fromJson(json.loads(kept["value"])) if kept else T.StructType([])
    known = {f.name.lower() for f in schema.fields}
    new: dict[str, T.StructField] = {}
    groups: dict[str, list[str]] = {}
    for name, line in first_lines(spark, listed(spark, path)).items():
        if line and {h.lower() for h in header_names(line)} - known:
            groups.setdefault(line, []).append(name)
    for line, names in sorted(groups.items()):
        found = spark.read.option("header", "true").option("inferSchema", "true").csv(names).schema
        for name, field in zip(header_names(line), found.fields):
            if name.lower() not in known:
                new.setdefault(name.lower(), T.StructField(name, field.dataType))
    if new:
        schema = T.StructType([*schema.fields, *new.values()])
        line = [((kept["version"] if kept else 0) + 1, schema.json())]
        spark.createDataFrame(line, "version INT, value STRING").coalesce(1).write.mode("append").json(store)
    return schema


# -- streams ---------------------------------------------------------------


def stream_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV stream with columns by position; a file whose header differs from the schema stops
    it. `streaming.jobs.load_csv` takes columns by name."""
    return spark.readStream.option("header", "true").option("enforceSchema", "false").schema(schema).csv(path)


def stream_file_names(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The names of the files of a folder as they arrive; the files are not opened."""
    reader = spark.readStream.format("binaryFile").schema("path STRING, modificationTime TIMESTAMP, length LONG, content BINARY")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select("path")


def stream_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Multi-line JSON stream; files present at the start are included."""
    return spark.readStream.schema(schema).option("multiLine", "true").json(path)


def stream_json_rescued(
    spark: SparkSession, path: str, schema: T.StructType, array_files: bool = True
) -> DataFrame:
    return rescue_json(_json_objects(spark.readStream, path, array_files), "value", schema)


def stream_parquet(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream over the files of a table folder; the schema is read from the footer once."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
