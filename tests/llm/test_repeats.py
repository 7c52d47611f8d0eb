"""Repeated passages against brute force."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from stratalake.llm import repeats
from stratalake.llm.queries import QUERIES

W = repeats.WINDOW


def brute(texts):
    """For each text whether each word goes."""
    split = [(t or "").encode().split() for t in texts]
    times = Counter(tuple(w[i : i + W]) for w in split for i in range(len(w) - W + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - W + 1):
            if times[tuple(w[i : i + W])] > 1:
                gone[i : i + W] = [True] * W
        out.append((w, gone))
    return out


def expected(texts):
    return [(len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()) for w, gone in brute(texts)]


def corpus(rng, n):
    """Passages of about a window's length set among prose, copies, and texts that repeat themselves."""
    prose = lambda k: [f"w{rng.randrange(400)}" for _ in range(k)]
    shared = [prose(rng.choice([17, 18, 30, 33, 34, 35, 36, 52, 53, 70, 120])) for _ in range(12)]
    texts = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += prose(rng.choice([0, 1, 7, 40]))
            words += rng.choice(shared)
            if rng.random() < 0.1:
                words += ["la"] * rng.choice([20, 35, 36, 37, 90])
        texts.append(" ".join(words))
    return texts + texts[:5]


def test_blocks_lie_in_every_window():
    assert 2 * repeats.BLOCK - 1 <= W < 2 * (repeats.BLOCK + 1) - 1


def test_rolling_hashes_tell_windows():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 63, 5, dtype=np.uint64)[rng.integers(0, 5, 3000)]
    for width in (1, 3, 18):
        marks = repeats.rolling(words, width, repeats.BASES[0])
        want = [tuple(words[i : i + width].tolist()) for i in range(len(words) - width + 1)]
        assert len(marks) == len(want) and len(set(zip(marks.tolist(), want))) == len(set(want)) == len(set(marks.tolist()))


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(spark, seed):
    texts = corpus(random.Random(seed), 120)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id INT, text STRING").repartition(7)
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in repeats.remove_repeats(docs).collect()}
    want = dict(enumerate(expected(texts)))
    assert found == want and 0 < sum(w[1] for w in want.values()) < sum(w[0] for w in want.values())


def test_spans_are_maximal(spark):
    shared = [f"s{i}" for i in range(60)]
    rows = [(1, "a b " + " ".join(shared) + " c"), (2, " ".join(shared[5:]) + " d"), (3, "e " + " ".join(shared[:34]))]
    found = {r.doc_id: [tuple(s) for s in r.removed] for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()}
    assert found == {1: [(7, 55)], 2: [(0, 55)], 3: []}


def test_edges(edges, empty):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    want = sorted(((d, *e) for (d, _), e in zip(rows, expected([t for _, t in rows]))), key=lambda r: (r[0] or 0, str(r)))
    found = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in repeats.remove_repeats(edges).collect()), key=lambda r: (r[0] or 0, str(r)))
    assert found == want
    assert repeats.remove_repeats(empty).count() == 0


def test_query_like_brute_force(spark, small):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{small}/documents.parquet'").fetchall()
    want = {d: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for (d, _), (n, gone, kept) in zip(docs, expected([t for _, t in docs]))}
    found = QUERIES["op12_substring_dedup"](spark, small)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == want
