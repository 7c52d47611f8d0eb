"""Prefix tries against brute force."""

import hashlib
import random

import duckdb
import pytest

from check_oracle import compare, connect
from stratalake.llm import prefix_trie
from stratalake.llm.queries import ORACLES, QUERIES

COLUMNS = [c.split()[0] for c in prefix_trie.NODE.split(", ")]


def brute(sequences):
    """{conv_id: [(role, text), ...]} -> rows of all nodes."""
    members = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = []
    for node, own in members.items():
        subtree = [v for v in members if v[: len(node)] == node]
        childless = lambda v: not any(len(w) == len(v) + 1 and w[: len(v)] == v for w in members)
        ends = ",".join(str(c) for c in sorted(c for c in own if len(sequences[c]) == len(node)))
        rows.append((
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own), sum(len(v) == len(node) + 1 for v in subtree),
            sum(map(childless, subtree)), sum((len(members[v]) - 1) * len(v[-1][1].encode()) for v in subtree if v), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=repr)


def frame(spark, sequences, extra=()):
    rows = [(c, i, role, text) for c, turns in sequences.items() for i, (role, text) in enumerate(turns)]
    rows += [(c, None, None, None) for c in extra]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id LONG, turn INT, role STRING, text STRING, sequence STRING, depth INT").repartition(5)


def found(paths, **options):
    return sorted((tuple(r) for r in prefix_trie.prefix_nodes(paths, **options).select(*COLUMNS).collect()), key=repr)


def talks(rng, n, most):
    turn = lambda: (rng.choice(["user", "system", ""]), rng.choice(["", "a", "bé", "ccc"]))
    shared = [turn() for _ in range(12)]
    return {c * 3 - 7: (shared[: rng.choice([0, 0, 3, 9, 12])] + [turn() for _ in range(rng.randint(0, most))]) or [turn()] for c in range(n)}


@pytest.mark.parametrize("shard, upper", [(20_000, 20_000), (1, 10**9), (5, 10**9), (30, 10**9)])
def test_like_brute_force(spark, shard, upper):
    sequences = talks(random.Random(shard), 150, 5)
    assert found(prefix_trie.paths_of(frame(spark, sequences)), shard=shard, upper=upper) == brute(sequences)


def test_one_sequence_and_copies(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    sequences = {c: [("user", "hi"), ("bot", "ho")] for c in range(100, 0, -1)}
    assert found(prefix_trie.paths_of(frame(spark, sequences))) == brute(sequences)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, None, None, "z"), (1, 0, "u", None), (1, 0, "u", None), (2, None, "", "z"), (2, 5, "u", ""), (2, 5, "u", ""), (None, 1, "u", "lost"), (3, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id LONG, turn INT, role STRING, text STRING")
    want = brute({1: [("", "z"), ("u", ""), ("u", "")], 2: [("", "z"), ("u", ""), ("u", "")], 3: [("", "")]})
    assert found(prefix_trie.paths_of(turns)) == want
    assert found(prefix_trie.paths_of(turns.where("false"))) == []
    assert found(prefix_trie.paths_of(turns.where("conv_id IS NULL"))) == []


def test_turnless_conversations(spark):
    paths = prefix_trie.paths_of(frame(spark, {1: [("u", "a")], 5: [("u", "b")]})).selectExpr("conv_id", "filter(turns, t -> conv_id = 1) AS turns")
    assert found(paths) == brute({1: [("u", "a")], 5: []})
    assert found(paths.where("conv_id = 5")) == brute({5: []})


def test_double_array_holds_what_was_packed_and_nothing_else():
    rng = random.Random(4)
    codes = sorted({tuple(rng.randrange(rng.choice([2, 40, 900])) for _ in range(rng.randint(1, 9))) for _ in range(3000)} | {tuple(range(300))})
    trie = prefix_trie.DoubleArray(codes)
    base, check = trie.arrays()
    prefixes = {c[:d] for c in codes for d in range(len(c) + 1)}
    states = {}
    for prefix in sorted(prefixes, key=len):
        states[prefix] = 0 if not prefix else int(base[states[prefix[:-1]]]) + prefix[-1]
        assert not prefix or check[states[prefix]] == states[prefix[:-1]]
    assert len(set(states.values())) == len(prefixes) == int((check != -1).sum())
    for prefix in rng.sample(sorted(prefixes), 500):
        for code in (0, 1, 17, 899):
            at = int(base[states[prefix]]) + code
            assert (prefix + (code,) in prefixes) == (0 <= at < len(check) and check[at] == states[prefix])
    assert len(check) < 2 * len(prefixes) + 1000


def test_query_like_its_sql(spark, small):
    assert "op13_prefix_trie" in ORACLES
    assert compare(spark, connect(small), "op13_prefix_trie", small) == ""
    found = QUERIES["op13_prefix_trie"](spark, small)
    assert found.columns == COLUMNS


def test_query_like_brute_force(spark, small):
    import zlib

    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{small}/conversations.parquet' ORDER BY conv_id, turn").fetchall()
    talks = {}
    for c, _, role, text in rows:
        talks.setdefault(c, []).append((role or "", text or ""))
    rebuilt = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = talks.get(c - c % 5, [])[:h] + own[h:]
    assert sorted((tuple(r) for r in QUERIES["op13_prefix_trie"](spark, small).collect()), key=repr) == brute(rebuilt)
