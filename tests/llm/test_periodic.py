"""Periodic runs against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import duckdb
import numpy as np

from stratalake.llm import periodic
from stratalake.llm.queries import QUERIES


def brute_runs(words):
    """Every maximal stretch of every period; the smallest period of a stretch counts."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            a = i
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - a + q >= max(6, 4 * q):
                out.setdefault((a - q, i - a + q), q)
    # a stretch may have a smaller period over a longer stretch
    smaller = lambda a, n, q: any(all(words[i] == words[i - p] for i in range(a + p, a + n)) for p in range(1, q))
    return sorted((a, n, q) for (a, n), q in out.items() if not smaller(a, n, q))


def found_runs(texts):
    ids, bounds = periodic.word_numbers(texts)
    out = [[] for _ in texts]
    for a, n, q in periodic.runs_of(ids, bounds):
        k = int(np.searchsorted(bounds, a, "right")) - 1
        out[k].append((a - int(bounds[k]), n, q))
    return [sorted(r) for r in out]


def tangled(rng, size):
    """Words of a small alphabet, with repeats inside repeats, cut and spoilt here and there."""
    out = []
    while len(out) < size:
        unit = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.choice([1, 2, 3, 5, 8, 13]))]
        if rng.random() < 0.5:
            unit = unit * rng.randint(1, 7) + [b"%d" % rng.randrange(4) for _ in range(rng.randint(0, 2))]
        out += (unit * rng.choice([1, 2, 4, 5, 9]))[: rng.randint(1, 200)]
        if rng.random() < 0.3:
            out[rng.randrange(len(out))] = b"x"
    return out[:size]


def test_runs_like_brute_force():
    rng = random.Random(2)
    for _ in range(120):
        texts = [tangled(rng, rng.choice([0, 1, 5, 6, 40, 160, 300])) for _ in range(rng.randint(1, 4))]
        assert found_runs(texts) == [brute_runs(t) for t in texts]


def test_runs_of_two_letter_words_exhaustively():
    texts = [[b"ab"[(x >> i) & 1 : ((x >> i) & 1) + 1] for i in range(13)] for x in range(1 << 13)]
    assert found_runs(texts) == [brute_runs(t) for t in texts]


def test_fibonacci_words_and_long_powers():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 600:
        a, b = b, b + a
    assert found_runs([b, [b"q"] * 700, b * 1]) == [brute_runs(b), [(0, 700, 1)], brute_runs(b)]


def test_hot_words_cost_no_square():
    n = 1_000_000
    assert found_runs([[b"a"] * n]) == [[(0, n, 1)]]
    pair = [b"a", b"b"] * (n // 4) + [b"c"] + [b"a"] * (n // 2)
    assert found_runs([pair]) == [[(0, n // 2, 2), (n // 2 + 1, n // 2, 1)]]
    rng = random.Random(1)
    assert all(r[1] >= 6 for r in found_runs([[b"ab"[rng.randrange(2) :][:1] for _ in range(100_000)]])[0])


def test_find_runs_edges(edges, empty, spark):
    rows = {(r.doc_id, r.n_words, r.collapsed): r.runs for r in periodic.find_runs(edges).collect()}
    assert periodic.find_runs(edges).count() == edges.count()
    assert [(tuple(r)) for r in rows[(7, 300_000, "lorem ipsum dolor sit amet")]] == [(0, 300_000, 5)]
    assert rows[(4, 0, "")] == rows[(None, 0, "")] == rows[(6, 0, "")] == []
    assert periodic.find_runs(empty).count() == 0
    text = "x a b a b a b a b a c c c c c c"
    r = periodic.find_runs(spark.createDataFrame([(1, text)], "doc_id LONG, text STRING")).first()
    assert (r.collapsed, [tuple(x) for x in r.runs]) == ("x a b c", [(1, 9, 2), (10, 6, 1)])


def rewritten(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_query_like_brute_force(spark, small):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{small}/documents.parquet'").fetchall()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {}
    for doc_id, text in docs:
        words = rewritten(doc_id, text)
        runs = brute_runs(words) if len(words) < 3000 else found_runs([words])[0]
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        kept = [w for i, w in enumerate(words) if not any(a + q <= i < a + n for a, n, q in runs)]
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
        want[doc_id] = (len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2], sha(lines.encode()), sha(b" ".join(kept)))
    found = QUERIES["op11_periodic_runs"](spark, small)
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert found.columns == columns and {r[0]: tuple(r)[1:] for r in found.collect()} == want
    assert sum(w[0] > 0 for w in want.values()) > 5
