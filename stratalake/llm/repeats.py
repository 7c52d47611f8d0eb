"""Repeated passages by fixed-block anchors.

A window is `WINDOW` consecutive words of one text. Every word covered by a window whose words
also start at another place, in another text or in the same one, is removed; windows are judged
on the input.

1. Texts are packed into chunks of a few megabytes, stored once.
2. Index and probes. Every text is cut into reference blocks of `BLOCK` words that do not overlap.
   A window is at least 2 * BLOCK - 1 words long, so it holds a whole reference block wherever it
   begins, and a copy of the window has these words, too. Every rolling window of BLOCK words probes the
   index: it is a hit if its words also stand elsewhere and one of the places is a reference block.
   Blocks and probes meet by bucket of their hash. A chunk sends the distinct ones once, as packed
   numbers, and gets one bit back for each: a passage in a third of all texts is a few numbers.
3. Extension. A hit is extended to each window that holds it; a window counts if another place has
   the same words, which the buckets tell by hashes of 64 bits and the bits that name the bucket.
   All places of a block are extended at once, so none is compared with all others, and none is left
   out. Windows that overlap make up the maximal repeats.

Null, empty and blank texts have no words; repeated rows are copies of each other; null ids stay;
an empty table gives no rows; other columns are not read. Python splits words in bytes as WORD does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import in_small_batches, staged
from stratalake.session import shuffle_width

WINDOW = 35
#: The longest block that every window holds whole, wherever blocks begin.
BLOCK = (WINDOW + 1) // 2
#: About so many probes meet in a bucket.
BUCKET_WORDS = 4_000_000
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
MIX = np.uint64(0xFF51AFD7ED558CCD)
KNOWN_WORDS = 1 << 19
SENT = "bucket long, chunk long, hashes binary, several binary, anchored binary"
REPLY = "chunk long, bucket long, bits binary"
SPANS = "array<struct<start: bigint, length: bigint>>"


class WordHashes(dict):
    """64-bit hashes of words; the words seen lately are kept."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = WordHashes()
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2^64."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = 1 << n.bit_length()
        steps = (np.full(size, b, np.uint64) for b in (base, pow(base, -1, 1 << 64)))
        both = []
        for step in steps:
            step[0] = 1
            both.append(np.cumprod(step))
        _powers[base] = (both[0], both[1])
    up, down = _powers[base]
    return up[:n], down[:n]


def rolling(words: np.ndarray, width: int, base: int) -> np.ndarray:
    """A hash of the `width` words that begin at each place where so many are left."""
    if len(words) < width:
        return np.empty(0, np.uint64)
    up, down = powers(base, len(words))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up, out=sums[1:])
    value = (sums[width:] - sums[:-width]) * down[: len(words) - width + 1]
    value ^= value >> np.uint64(32)
    value *= MIX
    return value ^ (value >> np.uint64(29))


class Chunk:
    """The words of some texts, one after the other."""

    def __init__(self, bodies: list[bytes | None]):
        self.texts = [(body or b"").split() for body in bodies]
        self.bounds = np.cumsum([0, *map(len, self.texts)])
        n = int(self.bounds[-1])
        self.words = np.fromiter((_hashes[w] for words in self.texts for w in words), np.uint64, n)
        sizes = np.diff(self.bounds)
        self.offset = np.arange(n) - np.repeat(self.bounds[:-1], sizes)
        self.left = np.repeat(self.bounds[1:], sizes) - np.arange(n)

    def probes(self, buckets: int) -> Probes:
        """All rolling windows of BLOCK words."""
        at = np.flatnonzero(self.left >= BLOCK)
        value = rolling(self.words, BLOCK, BASES[0])[at]
        return Probes(at, _bucket(value, buckets), value.astype(np.uint32), self.offset[at] % BLOCK == 0)

    def extensions(self, hits: np.ndarray, buckets: int) -> Probes:
        """All windows that hold a hit; `hits` are places of blocks."""
        marks = np.zeros(len(self.words) + 1, np.int64)
        marks[hits + 1] = 1
        marks = np.cumsum(marks)
        at = np.flatnonzero(self.left >= WINDOW)
        at = at[marks[at + WINDOW - BLOCK + 1] > marks[at]]
        value, other = (rolling(self.words, WINDOW, b)[at] for b in BASES[1:])
        return Probes(at, _bucket(other, buckets), value, np.ones(len(at), bool))


def _bucket(value: np.ndarray, buckets: int) -> np.ndarray:
    return (value >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


class Probes:
    """Places of a chunk with a hash each, brought together by bucket and hash."""

    def __init__(self, at: np.ndarray, bucket: np.ndarray, value: np.ndarray, anchored: np.ndarray):
        order = np.lexsort((value, bucket))
        self.at, bucket, value = at[order], bucket[order], value[order]
        new = np.append(True, (bucket[1:] != bucket[:-1]) | (value[1:] != value[:-1]))[: len(order)]
        self.group = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        self.bucket, self.value = bucket[first], value[first]
        self.several = np.diff(first, append=len(order)) > 1
        self.anchored = np.logical_or.reduceat(anchored[order], first) if len(first) else np.empty(0, bool)
        edges = np.flatnonzero(np.append(True, self.bucket[1:] != self.bucket[:-1])[: len(first)])
        self.parts = list(zip(edges.tolist(), np.append(edges[1:], len(first)).tolist())) if len(first) else []

    def sent(self, chunk: int) -> pa.Table:
        """A row per bucket."""
        columns = (
            pa.array([int(self.bucket[a]) for a, _ in self.parts], pa.int64()),
            pa.array([chunk] * len(self.parts), pa.int64()),
            pa.array([self.value[a:b].tobytes() for a, b in self.parts], pa.binary()),
            *(pa.array([np.packbits(x[a:b]).tobytes() for a, b in self.parts], pa.binary()) for x in (self.several, self.anchored)),
        )
        return pa.table(dict(zip(("bucket", "chunk", "hashes", "several", "anchored"), columns)))

    def repeated(self, replies: dict[int, bytes]) -> np.ndarray:
        """The places whose words the buckets have seen elsewhere."""
        found = np.zeros(len(self.value), bool)
        for a, b in self.parts:
            if (bits := replies.get(int(self.bucket[a]))) is not None:
                found[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
        return self.at[found[self.group]] if len(self.at) else self.at


def met(rows: pa.Table, kind: type) -> pa.Table:
    """What the chunks sent to one bucket: a bit for each number, set if its words stand at several
    places, one of them a reference block."""
    values = [np.frombuffer(x, kind) for x in rows["hashes"].to_pylist()]
    unpack = lambda name: [np.unpackbits(np.frombuffer(x, np.uint8), count=len(v)) for x, v in zip(rows[name].to_pylist(), values)]
    distinct, group = np.unique(np.concatenate(values), return_inverse=True)
    times = np.bincount(group, 1 + np.concatenate(unpack("several")), len(distinct))
    anchors = np.bincount(group, np.concatenate(unpack("anchored")), len(distinct))
    repeated = ((times > 1) & (anchors > 0))[group]
    bits = np.split(repeated, np.cumsum([len(v) for v in values])[:-1])
    out = [(c, b, np.packbits(x).tobytes()) for c, b, x in zip(rows["chunk"].to_pylist(), rows["bucket"].to_pylist(), bits) if x.any()]
    columns = list(zip(*out)) or [[], [], []]
    return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())], ["chunk", "bucket", "bits"])


def chunks_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(chunk, n_words, data): texts with their ids as compressed Arrow streams, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n = sum(len((body or b"").split()) for body in batch.column(1).cast(pa.binary()).to_pylist())
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["n_words", "data"])

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("body"))
    rows = in_small_batches(source).mapInArrow(run, "n_words long, data binary")
    return staged(rows.withColumn("chunk", F.monotonically_increasing_id()), "repeat-chunks")


def unpacked(data: bytes) -> tuple[pa.ChunkedArray, Chunk]:
    with pa.ipc.open_stream(data) as reader:
        rows = reader.read_all()
    return rows["doc_id"], Chunk(rows["body"].cast(pa.binary()).to_pylist())


def spans_of(chunk: Chunk, starts: np.ndarray) -> list[list[tuple[int, int]]]:
    """For each text the stretches (start, length) that windows at `starts` cover."""
    cover = np.zeros(len(chunk.words) + 1, np.int64)
    cover[starts] += 1
    np.subtract.at(cover, starts + WINDOW, 1)
    covered = np.cumsum(cover[:-1]) > 0
    out = []
    for a, b in zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist()):
        edges = np.flatnonzero(np.diff(covered[a:b], prepend=False, append=False)).tolist()
        out.append([(x, y - x) for x, y in zip(edges[::2], edges[1::2])])
    return out


def without(words: list[bytes], spans: list[tuple[int, int]]) -> str:
    at, kept = 0, []
    for start, length in spans:
        kept += words[at:start]
        at = start + length
    return b" ".join(kept + words[at:]).decode()


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, removed, kept), one row per row of `docs`.

    `removed` has the maximal stretches that go as (start, length) in words; `kept` is the rest,
    words joined by a blank."""
    chunks = chunks_of(docs, doc_id, text)
    total = chunks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    buckets = max(4 * shuffle_width(docs.sparkSession), total // BUCKET_WORDS)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield from unpacked(data.as_py())[1].probes(buckets).sent(chunk).to_batches()

    def found(rows: pa.Table, phase: int) -> dict[int, bytes]:
        return {b: x for p, b, x in zip(rows["phase"].to_pylist(), rows["bucket"].to_pylist(), rows["bits"].to_pylist()) if p == phase}

    def extend(chunk_rows: pa.Table, replies: pa.Table) -> pa.Table:
        _, chunk = unpacked(chunk_rows["data"][0].as_py())
        hits = chunk.probes(buckets).repeated(found(replies, 1))
        return chunk.extensions(hits, buckets).sent(chunk_rows["chunk"][0].as_py())

    def clean(chunk_rows: pa.Table, replies: pa.Table) -> pa.Table:
        ids, chunk = unpacked(chunk_rows["data"][0].as_py())
        spans: list[list[tuple[int, int]]] = [[] for _ in chunk.texts]
        if second := found(replies, 2):
            hits = chunk.probes(buckets).repeated(found(replies, 1))
            spans = spans_of(chunk, chunk.extensions(hits, buckets).repeated(second))
        flat = list(zip(*[s for own in spans for s in own])) or [[], []]
        structs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in flat], ["start", "length"])
        removed = pa.ListArray.from_arrays(np.cumsum([0, *map(len, spans)]).astype(np.int32), structs)
        counts = pa.array([sum(n for _, n in own) for own in spans], pa.int64())
        sizes = pa.array(np.diff(chunk.bounds), pa.int64())
        kept = pa.array([without(words, own) for words, own in zip(chunk.texts, spans)], pa.string())
        return pa.table([ids, sizes, counts, removed, kept], ["doc_id", "n_words", "n_removed", "removed", "kept"])

    def told(sent: DataFrame, kind: type, phase: int) -> DataFrame:
        replies = sent.groupBy("bucket").applyInArrow(lambda rows: met(rows, kind), REPLY)
        return staged(replies.withColumn("phase", F.lit(phase)), f"repeat-replies-{phase}")

    # A chunk that got no reply has nothing to extend.
    hits = told(chunks.select("chunk", "data").mapInArrow(probe, SENT), np.uint32, 1)
    extensions = chunks.select("chunk", "data").groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInArrow(extend, SENT)
    replies = hits.unionByName(told(extensions, np.uint64, 2))
    shape = f"doc_id {dict(docs.dtypes)[doc_id]}, n_words long, n_removed long, removed {SPANS}, kept string"
    return chunks.select("chunk", "data").groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(clean, shape)
