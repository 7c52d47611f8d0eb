"""WARC archives as a Spark data source (`warc`): a writer and a reader with header push-down.

Reading. One partition per file (the writer starts a new file at `max_file_bytes`). A record's
headers are parsed first; record type, ids and target address are tested there, and a record
that is not wanted is skipped: by its content length in plain files, by the member length that
the gzip header carries (extra field `sl`) in compressed ones, by running through it where a
foreign file has no such field. The payload is decoded only if the schema asked for has it.

Writing. Every task attempt writes files of its own; the driver lists the committed ones in
`_records.json`, and readers go by that list, so a lost or repeated attempt leaves no records.
Paths go through Arrow's file systems; on a cluster they must be in a store all executors share.

Record frames have the columns of `SCHEMA`; digests are read as bare hex. Null addresses and references are left out of the
headers; a null payload is an empty one; control characters in header values are dropped.
Records without an HTTP block have the whole block as payload.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, "
    "payload_length long, headers map<string,string>, payload binary"
)
HEADER_COLUMNS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}
MANIFEST, PEEK, FILE_BYTES = "_records.json", 1 << 16, 256 << 20
KNOWN = {*HEADER_COLUMNS.values(), "content-length", "content-type", "warc-profile"}


# --- records --------------------------------------------------------------------------------


def clean(value) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", "", str(value))


def sha1_label(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def digest_hex(label: str | None) -> str | None:
    """Lower-case hex of a `sha1:` label in Base32 or hex."""
    value = (label or "").partition(":")[2]
    if len(value) == 32:
        return base64.b32decode(value.upper()).hex()
    return value.lower() or None


def record_bytes(row: dict) -> bytes:
    """One record; a revisit keeps the HTTP headers of the full response and leaves the body out."""
    payload, kind = row.get("payload") or b"", row["record_type"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {clean(kind)}", f"WARC-Record-ID: <{clean(row['record_id'])}>", f"WARC-Date: {clean(row['date'])}"]
    if row.get("target_uri") is not None:
        lines.append(f"WARC-Target-URI: {clean(row['target_uri'])}")
    if row.get("refers_to") is not None:
        lines.append(f"WARC-Refers-To: <{clean(row['refers_to'])}>")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines += [f"{clean(k)}: {clean(v)}" for k, v in row.get("headers") or [] if v is not None]
    lines += [f"WARC-Payload-Digest: {sha1_label(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    """A gzip member whose extra field has the lengths of the member and of the record."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    lengths = (size, len(record)) if max(size, len(record)) < 1 << 32 else (0, 0)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, *lengths)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def parse_head(data: bytes) -> tuple[dict[str, str], int] | None:
    """Headers (lower-case names) and the offset behind them; None when more bytes are needed."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    lines = data[:end].decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    out: dict[str, str] = {}
    name = ""
    for line in lines[1:]:
        if line[:1] in " \t" and name:  # folded header
            out[name] += " " + line.strip()
        else:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            out[name] = value.strip()
    return out, end + 4


def header(head: dict[str, str], column: str) -> str | None:
    value = head.get(HEADER_COLUMNS[column])
    return value.strip("<>") if value is not None and column in ("record_id", "refers_to") else value


@dataclass
class Test:
    """A predicate on one header column."""

    column: str
    kind: str
    value: object = None

    def holds(self, head: dict[str, str]) -> bool:
        found = header(head, self.column)
        if self.kind in ("null", "not null"):
            return (found is None) == (self.kind == "null")
        if found is None:
            return False
        return {
            "=": lambda: found == self.value,
            "in": lambda: found in self.value,
            "starts": lambda: found.startswith(self.value),
            "ends": lambda: found.endswith(self.value),
            "contains": lambda: self.value in found,
        }[self.kind]()


KINDS = {EqualTo: "=", In: "in", IsNull: "null", IsNotNull: "not null", StringStartsWith: "starts", StringEndsWith: "ends", StringContains: "contains"}


def as_test(f) -> Test | None:
    """The predicate as a header test, if it is one."""
    if type(f) not in KINDS or len(f.attribute) != 1 or f.attribute[0] not in HEADER_COLUMNS or f.attribute[0] == "payload_digest":
        return None
    return Test(f.attribute[0], KINDS[type(f)], tuple(f.value) if isinstance(f, In) else getattr(f, "value", None))


# --- files ----------------------------------------------------------------------------------


def located(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:/"):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def planned(path: str) -> list[str]:
    """The committed files below a folder, or all its archives; a file stands for itself."""
    system, place = located(path)
    info = system.get_file_info(place)
    if info.type == fs.FileType.File:
        return [place]
    if system.get_file_info(f"{place}/{MANIFEST}").type == fs.FileType.File:
        with system.open_input_stream(f"{place}/{MANIFEST}") as f:
            return [f"{place}/{name}" for name in json.loads(f.read())]
    found = system.get_file_info(fs.FileSelector(place, recursive=True))
    return sorted(i.path for i in found if i.path.endswith((".warc", ".warc.gz")) and not i.base_name.startswith(("_", ".")))


@dataclass
class Scan:
    """One pass over a file: headers, tests, then the payload if it is wanted."""

    tests: list[Test] = field(default_factory=list)
    payload: bool = True

    def file(self, source, size: int, packed: bool) -> Iterator[tuple[dict[str, str], bytes, int | None]]:
        """(headers, start of the block or the whole block, position of the record)"""
        at = 0
        while at < size:
            source.seek(at)
            peek = source.read(min(PEEK, size - at))
            if not peek.strip(b"\r\n\0 "):
                at += len(peek)
                continue
            if packed:
                at = yield from self._packed(source, at, peek)
                continue
            at += len(peek) - len(peek.lstrip(b"\r\n"))
            head, block, at = self._plain(source, at)
            if head is not None:
                yield head, block, at

    def _wanted(self, head: dict[str, str]) -> bool:
        return all(t.holds(head) for t in self.tests)

    def _plain(self, source, at: int):
        source.seek(at)
        data = source.read(PEEK)
        while (parsed := parse_head(data)) is None:
            more = source.read(PEEK)
            if not more:
                raise ValueError(f"record at {at} ends inside its headers")
            data += more
        head, start = parsed
        length = int(head.get("content-length") or 0)
        after = at + start + length + 4
        if not self._wanted(head):
            return None, b"", after
        need = start + (length if self.payload else min(length, PEEK))
        if len(data) < need:
            data += source.read(need - len(data))
        return head, data[start : start + length], after

    def _packed(self, source, at: int, data: bytes):
        """The records of one gzip member; returns the position behind it. What follows the last record
        that is wanted is neither read nor decoded if the lengths of member and records are known."""
        length = whole = 0
        if data[3] & 4:
            extra = data[12 : 12 + struct.unpack_from("<H", data, 10)[0]]
            if extra[:2] == b"sl" and len(extra) >= 12:
                length, whole = struct.unpack_from("<II", extra, 4)
        member = Member(source, data)
        while member.to_record():
            while (parsed := parse_head(member.held)) is None:
                if not member.more():
                    raise ValueError(f"record at {at} ends inside its headers")
            head, start = parsed
            size = int(head.get("content-length") or 0)
            last = 0 < whole <= member.at + start + size + 4 and length > 0
            member.skip(start)
            taken = 0
            if self._wanted(head):
                block = member.take(size if self.payload else min(size, 4096))  # enough for the HTTP headers
                taken = len(block)
                yield head, block, at
            if last:
                return at + length
            member.skip(size - taken)
        return member.end()


class Member:
    """The bytes of one gzip member, inflated as far as they are asked for."""

    def __init__(self, source, data: bytes):
        self.source, self.fed, self.unpack = source, data, zlib.decompressobj(31)
        self.held, self.at = bytearray(), 0  # bytes that wait, and how many came before them

    def more(self) -> bool:
        """Inflate some more, if there is more."""
        while not self.unpack.eof:
            fed = self.fed or self.source.read(PEEK)
            piece = self.unpack.decompress(fed, PEEK)
            self.fed = self.unpack.unconsumed_tail
            self.held += piece
            if piece or not fed:
                return bool(piece)
        return False

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.more():
            pass
        out = bytes(self.held[:n])
        del self.held[:n]
        self.at += len(out)
        return out

    def skip(self, n: int) -> None:
        while n > 0:
            gone = min(n, len(self.held))
            del self.held[:gone]
            self.at += gone
            n -= gone
            if n and not self.more():
                return

    def to_record(self) -> bool:
        """Pass over the line ends between records; whether a record follows."""
        while True:
            self.skip(len(self.held) - len(self.held.lstrip(b"\r\n\0 ")))
            if self.held:
                return True
            if not self.more():
                return False

    def end(self) -> int:
        """Position behind the member, once all of it is inflated."""
        return self.source.tell() - len(self.unpack.unused_data) - len(self.fed)


def split_http(head: dict[str, str], block: bytes) -> tuple[int, bytes]:
    """Length of the full payload and the bytes of it that the block has."""
    if "application/http" in head.get("content-type", "") and (end := block.find(b"\r\n\r\n")) >= 0:
        said = re.search(rb"\r\ncontent-length:\s*(\d+)", block[: end + 2], re.I)
        body = block[end + 4 :]
        return (int(said[1]) if said else int(head.get("content-length") or 0) - end - 4), body
    return int(head.get("content-length") or 0), block


class WarcReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str], schema: pa.Schema):
        self.path, self.columns, self.schema, self.tests = path, columns, schema, []

    def pushFilters(self, filters):
        for f in filters:
            test = as_test(f)
            if test is None:
                yield f
            else:
                self.tests.append(test)

    def partitions(self):
        return [InputPartition(p) for p in planned(self.path)]

    def read(self, partition):
        if partition is None:  # no file at all
            return
        system, _ = located(self.path)
        name, scan = partition.value, Scan(self.tests, "payload" in self.columns)
        size = system.get_file_info(name).size
        rows, held = [], 0
        with system.open_input_file(name) as source:
            for head, block, _ in scan.file(source, size, name.endswith(".gz")):
                length, body = split_http(head, block)
                row = {c: header(head, c) for c in HEADER_COLUMNS if c in self.columns}
                if "payload_digest" in row:
                    row["payload_digest"] = digest_hex(row["payload_digest"])
                row |= {"payload_length": length, "headers": [(k, v) for k, v in head.items() if k not in KNOWN], "payload": body}
                rows.append({c: row.get(c) for c in self.columns})
                held += len(body) if scan.payload else 64
                if held > 8 << 20 or len(rows) >= 4096:
                    yield pa.RecordBatch.from_pylist(rows, self.schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, self.schema)


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, packed: bool, file_bytes: int):
        self.path, self.packed, self.file_bytes = path, packed, file_bytes

    def write(self, iterator):
        system, place = located(self.path)
        system.create_dir(place, recursive=True)
        names, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    names.append(f"{uuid.uuid4().hex}.warc{'.gz' if self.packed else ''}")
                    out, size = system.open_output_stream(f"{place}/{names[-1]}", compression=None), 0
                data = record_bytes(row)
                data = member(data) if self.packed else data
                out.write(data)
                size += len(data)
                if size >= self.file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(names)

    def start(self):
        """An empty list in a folder without archives: what a failed first job leaves is then in no list."""
        system, place = located(self.path)
        system.create_dir(place, recursive=True)
        if not planned(self.path) and system.get_file_info(f"{place}/{MANIFEST}").type != fs.FileType.File:
            with system.open_output_stream(f"{place}/{MANIFEST}") as f:
                f.write(b"[]")
        return self

    def commit(self, messages):
        system, place = located(self.path)
        system.create_dir(place, recursive=True)
        before = []
        if system.get_file_info(f"{place}/{MANIFEST}").type == fs.FileType.File:
            with system.open_input_stream(f"{place}/{MANIFEST}") as f:
                before = json.loads(f.read())
        names = before + sorted(n for m in messages if m for n in m.names)
        with system.open_output_stream(f"{place}/{MANIFEST}") as f:
            f.write(json.dumps(names).encode())

    def abort(self, messages):
        """Remove the files of the tasks that ended; what a broken task left is in no list."""
        system, place = located(self.path)
        for name in (n for m in messages if m for n in m.names):
            if system.get_file_info(f"{place}/{name}").type == fs.FileType.File:
                system.delete_file(f"{place}/{name}")


class WarcDataSource(DataSource):
    """Options: path, `compression` (gzip or none), `max_file_bytes`."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        from pyspark.sql.pandas.types import to_arrow_schema

        return WarcReader(self.options["path"], schema.names, to_arrow_schema(schema))

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("archives are only appended to; write to a new folder")
        packed = self.options.get("compression", "gzip") != "none"
        return WarcWriter(self.options["path"], packed, int(self.options.get("max_file_bytes", FILE_BYTES))).start()


def write_warc(records: DataFrame, path: str, **options: str) -> None:
    records.sparkSession.dataSource.register(WarcDataSource)
    records.write.format("warc").mode("append").options(**options).save(path)


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Records of a file or folder; with `columns`, only those are decoded."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    source = spark.read.format("warc")
    if columns:
        full = dict(c.split(" ", 1) for c in SCHEMA.split(", "))
        source = source.schema(", ".join(f"{c} {full[c]}" for c in columns))
    return source.load(path)


# --- pages ----------------------------------------------------------------------------------

LEAST_REVISIT, DATE = 1000, "2024-01-01T00:00:00Z"


def urn(name) -> F.Column:
    return F.concat(F.lit("urn:uuid:"), F.regexp_replace(F.md5(name.cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


def page_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_REVISIT, date: str = DATE) -> DataFrame:
    """Pages as records: of equal payloads of at least `least` bytes the one with the largest id
    is the response and the others revisit it.

    Only hashes and ids are grouped; payloads move for nothing but a list of shared hashes that
    is too large to broadcast. Rows that repeat the largest id are responses, too; a null id
    revisits the largest one if there is any.
    """
    from stratalake.llm.common import join_checked, staged

    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload")
    ).withColumn("hash", F.when(F.octet_length("payload") >= least, F.sha2("payload", 256)))
    shared = rows.where("hash is not null").groupBy("hash").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = staged(shared.where("n > 1 and first is not null").select("hash", "first"), "warc-shared")
    joined = join_checked(rows, shared, "hash", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = lambda c: urn(F.concat(F.lit("page:"), c.cast("string")))
    nameless = urn(F.concat_ws(":", F.lit("nameless"), F.sha1("payload"), F.coalesce("url", F.lit(""))))
    extra = F.create_map(
        F.lit("X-Page-ID"), F.col("page_id").cast("string"), F.lit("X-Refers-To-Page"), F.when(revisit, F.col("first")).cast("string")
    )
    return joined.select(
        F.coalesce(name(F.col("page_id")), nameless).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.when(revisit, name(F.col("first"))).alias("refers_to"),
        F.lit(None).cast("string").alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_length"),
        extra.alias("headers"),
        "payload",
    )


def page_facts(records: DataFrame) -> DataFrame:
    """What the archives say of each page; the digest of a response is taken from its payload."""
    full = F.col("record_type") == "response"
    return records.select(
        F.col("headers")["x-page-id"].cast("long").alias("page_id"),
        F.when(full, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(full, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        F.col("headers")["x-refers-to-page"].cast("long").alias("refers_to"),
        "target_uri",
        "record_id",
    )
