"""Shared prefixes of conversations, in double-array tries.

A conversation is its turns in order; a turn is its role and text, told by a 128-bit hash. Every
distinct prefix is a node, from the empty root; the conversations that begin with it are its
members.

1. Conversations with equal turns become one sequence. Their ids are sorted by range of (sequence, id)
   and joined piece by piece; the pieces of a sequence are then hashed as they stream by, so a
   sequence that a third of all conversations share is neither sorted nor held by one task.
2. Upper nodes have more sequences below them than a task's share, `SHARD` at most (of very many: more
   than one in `UPPER`). So there are at most `UPPER`, or as many as shuffle tasks, at each depth, and
   that many times the mean number of turns in all: this set may go through the driver. The root is always one. Everything else hangs below an upper node in
   subtrees of at most that many sequences: the prefix shards, of which small ones share a task.
3. A shard numbers its turns densely and packs its subtrees into BASE and CHECK arrays: the child of
   node s by turn c is BASE[s] + c if CHECK there is s. Sequences walk through the arrays, all at
   once, and leave their counts at the nodes; sums over subtrees go back along CHECK.
4. What the shards found is added up by upper node, and upper nodes are summed over theirs.

Rows without a conversation id belong to no conversation and are left out. A null turn number comes
first; rows with the same number are ordered by their hash; null roles and texts are empty. An empty
table has no root. The turns of a conversation (24 bytes each) are held by one task. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import in_small_batches, staged
from stratalake.session import shuffle_width

SHARD, UPPER, LEAST = 20_000, 20_000, 32
PIECE = 4096
TRIES = 64
ROOT = hashlib.md5(b"").digest()
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


def paths_of(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): of each conversation the array of its turns (mark, bytes) in order."""
    who, what = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    mark = F.unhex(F.md5(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, what)))
    rows = turns.where(F.col(conv_id).isNotNull())
    rows = rows.select(F.col(conv_id).alias("conv_id"), F.struct(F.col(turn).alias("turn"), mark.alias("mark"), F.octet_length(what).cast("long").alias("bytes")).alias("t"))
    ordered = F.sort_array(F.collect_list("t"))  # nulls first
    return rows.groupBy("conv_id").agg(ordered.alias("t")).select("conv_id", F.transform("t", lambda t: F.struct(t["mark"], t["bytes"])).alias("turns"))


def _sequence(turns: Column) -> Column:
    return F.unhex(F.md5(F.array_join(F.transform(turns, lambda t: F.hex(t["mark"])), "")))


def ends_of(members: DataFrame) -> DataFrame:
    """(sequence, n_convs, least, ends_sha256) of (sequence, conv_id): the hash of the ids, ascending."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            edges = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]]
            cuts = [(a, min(a + PIECE, b)) for x, b in zip(edges, [*edges[1:], len(names)]) for a in range(x, b, PIECE)]
            rows = [(names[a], ids[a], b - a, ",".join(map(str, ids[a:b]))) for a, b in cuts]
            yield _batch(rows, [pa.binary(), pa.int64(), pa.int64(), pa.string()], ["sequence", "least", "n", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, names = [pa.binary(), pa.int64(), pa.int64(), pa.string()], ["sequence", "n_convs", "least", "ends_sha256"]
        name, count, least, hashed = None, 0, 0, None
        for batch in batches:
            done = []
            for sequence, first, n, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if sequence != name:
                    if hashed:
                        done.append((name, count, least, hashed.hexdigest()))
                    name, count, least, hashed = sequence, 0, first, hashlib.sha256()
                elif count:
                    hashed.update(b",")
                hashed.update(ids.encode())
                count += n
            yield _batch(done, kinds, names)
        if hashed:
            yield _batch([(name, count, least, hashed.hexdigest())], kinds, names)

    width = shuffle_width(members.sparkSession)
    ranged = members.repartitionByRange(width, "sequence", "conv_id").sortWithinPartitions("sequence", "conv_id")
    parts = ranged.mapInArrow(pieces, "sequence binary, least long, n long, ids string")
    parts = in_small_batches(parts.repartition(width, "sequence").sortWithinPartitions("sequence", "least"))
    return parts.mapInArrow(digests, "sequence binary, n_convs long, least long, ends_sha256 string")


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def prefix_keys(marks: list[bytes]) -> Iterator[bytes]:
    """A 128-bit name of each prefix, the empty one first."""
    key = ROOT
    yield key
    for mark in marks:
        key = hashlib.md5(key + mark).digest()
        yield key


def upper_nodes(sequences: DataFrame, most: int) -> DataFrame:
    """(key, depth, parent, bytes, n_convs, least) of the root and of nodes with over `most` sequences."""
    names = ["key", "depth", "parent", "bytes", "sequences", "n_convs", "least"]
    kinds = [pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes, list] = {}
            for marks, sizes, n, least in zip(*[c.to_pylist() for c in batch.columns]):
                parent = None
                for depth, key in enumerate(prefix_keys(marks)):
                    node = seen.setdefault(key, [depth, parent, sizes[depth - 1] if depth else 0, 0, 0, least])
                    node[3:] = node[3] + 1, node[4] + n, min(node[5], least)
                    parent = key
            yield _batch([(k, *v) for k, v in seen.items()], kinds, names)

    rows = in_small_batches(sequences.select("marks", "sizes", "n_convs", "least"))
    rows = rows.mapInArrow(run, "key binary, depth long, parent binary, bytes long, sequences long, n_convs long, least long")
    same = [F.max(c).alias(c) for c in ("depth", "parent", "bytes")]
    nodes = rows.groupBy("key").agg(*same, *[F.sum(c).alias(c) for c in ("sequences", "n_convs")], F.min("least").alias("least"))
    return nodes.where((F.col("sequences") > most) | (F.col("depth") == 0)).select("key", "depth", "parent", "bytes", "n_convs", "least")


class DoubleArray:
    """A trie in two arrays. `codes` are the sequences of a shard, sorted, of codes from 0."""

    def __init__(self, codes: list[tuple[int, ...]]):
        self.base: list[int] = [0]
        self.check: list[int] = [-2]  # the root belongs to nobody, -1 is free
        self._free = 1
        waiting = [(0, 0, len(codes), 0)]
        while waiting:
            state, low, high, depth = waiting.pop()
            while low < high and len(codes[low]) == depth:
                low += 1  # ends here
            groups = []
            while low < high:
                code, at = codes[low][depth], low + 1
                while at < high and codes[at][depth] == code:
                    at += 1
                groups.append((code, low, at))
                low = at
            if groups:
                base = self.base[state] = self._place([g[0] for g in groups])
                for code, a, b in groups:
                    self.check[base + code] = state
                    waiting.append((base + code, a, b, depth + 1))

    def _place(self, children: list[int]) -> int:
        """A base at which the places of all children are free; the arrays grow to hold them."""
        while self._free < len(self.check) and self.check[self._free] != -1:
            self._free += 1
        at, size = self._free, len(self.check)
        for _ in range(TRIES):
            base = at - children[0]
            if all(base + c >= size or self.check[base + c] == -1 for c in children):
                break
            at += 1
            while at < size and self.check[at] != -1:
                at += 1
        else:
            base = size - children[0]
        grow = base + children[-1] + 1 - size
        if grow > 0:
            self.base += [0] * grow
            self.check += [-1] * grow
        return base

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array(self.base, np.int64), np.array(self.check, np.int64)


def shard_nodes(rows: pa.Table, least_of: dict[bytes, int]) -> pa.Table:
    """The nodes of a shard; `top`, for the uppermost ones, is their parent's key."""
    heads, parents, depths, marks, sizes, counts, least, ends = (
        rows[c].to_pylist() for c in ("head", "parent", "depth", "marks", "sizes", "n_convs", "least", "ends_sha256")
    )
    # The first step of a sequence stands for its whole prefix down to the shard's own part.
    turns = [[head, *own] for head, own in zip(heads, marks)]
    dense = {mark: i for i, mark in enumerate(sorted({m for own in turns for m in own}))}
    codes = [tuple(dense[m] for m in own) for own in turns]
    order = sorted(range(len(codes)), key=codes.__getitem__)
    base, check = DoubleArray([codes[i] for i in order]).arrays()

    size = len(check)
    n_convs, first, last, depth = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max), np.zeros(size, np.int64), np.zeros(size, np.int64)
    lengths = np.array([len(c) for c in codes])
    begins = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.fromiter((c for own in codes for c in own), np.int64, begins[-1])
    bytes_ = np.fromiter((b for own in sizes for b in own), np.int64, begins[-1])
    own_n, own_least, own_depth = (np.array(x, np.int64) for x in (counts, least, depths))
    state, levels = np.zeros(len(codes), np.int64), []
    for step in range(int(lengths.max())):
        on = np.flatnonzero(lengths > step)
        place = begins[on] + step
        target = base[state[on]] + flat[place]
        assert (check[target] == state[on]).all()
        state[on] = target
        np.add.at(n_convs, target, own_n[on])
        np.minimum.at(first, target, own_least[on])
        last[target], depth[target] = bytes_[place], own_depth[on] + step
        levels.append(np.unique(target))

    n_children = np.bincount(check[check >= 0], minlength=size)
    n_leaves, saved = (n_children == 0).astype(np.int64), (n_convs - 1) * last
    for nodes in reversed(levels[1:]):
        np.add.at(n_leaves, check[nodes], n_leaves[nodes])
        np.add.at(saved, check[nodes], saved[nodes])
    hashes, top = np.full(size, NO_ENDS, object), np.full(size, None, object)
    hashes[state] = np.array(ends, object)
    parent = first[np.maximum(check, 0)]
    for head, key in zip(heads, parents):
        at = int(base[0]) + dense[head]
        top[at], parent[at] = key, least_of[key]
    nodes = np.concatenate(levels)
    numbers = (first, depth, parent, n_convs, n_children, n_leaves, saved)
    columns = [*(pa.array(x[nodes], pa.int64()) for x in numbers), pa.array(hashes[nodes], pa.string()), pa.array(top[nodes], pa.binary())]
    return pa.table(columns, [c.split()[0] for c in NODE.split(", ")] + ["top"])


def prefix_nodes(paths: DataFrame, shard: int = SHARD, upper: int = UPPER) -> DataFrame:
    """One row per node of (conv_id, turns), as `paths_of` gives them; `conv_id` is a whole number.

    conv_id, the smallest member; depth; parent_conv_id (root: null); n_convs, members; n_children;
    n_leaves, childless nodes of the subtree; saved_tokens, over the subtree the members beyond the
    first times the bytes of the last text; ends_sha256, of the ids of the members that end here."""
    spark = paths.sparkSession
    rows = paths.select(F.col("conv_id").cast("long").alias("conv_id"), "turns").where("conv_id IS NOT NULL")
    rows = staged(rows.withColumn("sequence", _sequence(F.col("turns"))), "trie-paths")
    ends = staged(ends_of(rows.select("sequence", "conv_id")), "trie-ends")
    own = rows.select(F.col("conv_id").alias("least"), F.col("turns.mark").alias("marks"), F.col("turns.bytes").alias("sizes"))
    sequences = staged(ends.join(own, "least"), "trie-sequences")
    total = sequences.count()
    most = max(total // upper, min(shard, max(LEAST, total // shuffle_width(spark))))
    known = upper_nodes(sequences, most).collect()  # bounded by (2)
    least_of = {bytes(r.key): r.least for r in known}
    shards = max(shuffle_width(spark), 2 * total // most)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A sequence without its upper part; one that ends there keeps only its end (no shard)."""
        names = ["shard", "head", "parent", "depth", "marks", "sizes", "n_convs", "least", "ends_sha256"]
        lists = [pa.list_(pa.binary()), pa.list_(pa.int64())]
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), *lists, pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            out = []
            for marks, sizes, n, least, ends_here in zip(*[c.to_pylist() for c in batch.columns]):
                parent = None
                for depth, key in enumerate(prefix_keys(marks)):
                    if key not in least_of:
                        number = int.from_bytes(key[:7], "big") % shards
                        out.append((number, key, parent, depth, marks[depth:], sizes[depth - 1 :], n, least, ends_here))
                        break
                    parent = key
                else:
                    out.append((None, None, parent, len(marks), [], [], n, least, ends_here))
            yield _batch(out, kinds, names)

    shape = "shard long, head binary, parent binary, depth long, marks array<binary>, sizes array<long>, n_convs long, least long, ends_sha256 string"
    parts = in_small_batches(sequences.select("marks", "sizes", "n_convs", "least", "ends_sha256")).mapInArrow(cut, shape)
    parts = staged(parts, "trie-parts")
    inner = parts.where("shard IS NOT NULL").groupBy("shard").applyInArrow(lambda x: shard_nodes(x, least_of), f"{NODE}, top binary")
    inner = staged(inner, "trie-nodes")

    # Upper nodes: what hangs below them, then theirs, deepest first.
    ends_at = {bytes(r.parent): r.ends_sha256 for r in parts.where("shard IS NULL").select("parent", "ends_sha256").collect()}
    sums = inner.where("top IS NOT NULL").groupBy("top").agg(F.count(F.lit(1)).alias("n"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    below = {bytes(r.top): [r.n, r.leaves, r.saved] for r in sums.collect()}
    merged = []
    for r in sorted(known, key=lambda r: -r.depth):
        children, leaves, saved = below.get(bytes(r.key), (0, 0, 0))
        leaves, saved = leaves or 1, saved + (r.n_convs - 1) * r.bytes
        parent = bytes(r.parent) if r.depth else None
        if parent:
            over = below.setdefault(parent, [0, 0, 0])
            over[:] = over[0] + 1, over[1] + leaves, over[2] + saved
        merged.append((r.least, r.depth, least_of.get(parent), r.n_convs, children, leaves, saved, ends_at.get(bytes(r.key), NO_ENDS)))
    return inner.drop("top").unionByName(spark.createDataFrame(merged, NODE))
