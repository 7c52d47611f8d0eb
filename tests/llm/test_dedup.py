"""Exact and near duplicates, and components, against brute force."""

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from stratalake.llm import exact_dedup, simhash
from stratalake.llm.common import keyed, table
from stratalake.llm.components import components


def brute_exact(rows):
    """rows (key, doc_id, text) -> {key: (keep_key, size)}"""
    groups = {}
    for key, doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, key))
    return {m[3]: (min(members)[3], len(members)) for members in groups.values() for m in members}


def exact_result(df, key, **options):
    return {r.key: (r.keep_key, r.group_size) for r in exact_dedup.exact_groups(df, F.col(key), **options).collect()}


def test_exact_edges(edges):
    df, key = keyed(edges, "t")
    want = brute_exact([(r[key], r.doc_id, r.text) for r in df.collect()])
    assert exact_result(df, key) == want
    kept = exact_dedup.keep_first(df, key)
    assert kept.columns == df.columns
    assert sorted(r[key] for r in kept.collect()) == sorted({k for k, _ in want.values()})


def test_exact_collisions_are_told_apart(edges, spark, small):
    weak = lambda c: F.substring(F.md5(c), 1, 1)  # noqa: E731  sixteen hashes for everything
    for source in (edges, table(spark, small, "documents")):
        df, key = keyed(source, "t")
        assert exact_result(df, key, content_hash=weak) == exact_result(df, key)


def test_exact_empty(empty):
    assert exact_dedup.exact_groups(empty).count() == 0


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode())
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """Distinct fingerprints -> representative, by all pairs."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def brute_near(rows):
    """rows (key, doc_id, text) -> {key: (fingerprint, component_id)}"""
    marks = {key: brute_fingerprint(text) for key, _, text in rows}
    roots = brute_components(marks.values())
    least = {}
    for key, doc_id, _ in rows:
        r = roots[marks[key]]
        least[r] = min(least.get(r, (True, 0)), (doc_id is None, doc_id or 0))
    name = lambda x: None if x[0] else x[1]
    return {key: (f"{marks[key]:016x}", name(least[roots[marks[key]]])) for key, _, _ in rows}


def test_fingerprint_and_hash_agree_with_spark(spark):
    texts = ["One two THREE four", "x", "", None, "Ä Ö ü one TWO", "a " * 200_000]
    assert [simhash.fingerprint(t) for t in texts] == [brute_fingerprint(t) for t in texts]
    row = spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()[0]
    assert row % (1 << 64) == xxhash.xxh64_intdigest(b"one two three", 42)


def test_masks_cover_every_pair():
    rng = random.Random(3)
    masks = simhash.masks()
    assert len(masks) == 15
    for _ in range(3000):
        difference = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
        assert any(m & difference == 0 for m in masks)
    assert all(30 <= m.bit_count() <= 36 for m in masks)


def test_forest_connects_like_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62, 12)
    values = np.unique(np.concatenate([base[i % 12] ^ (1 << rng.integers(0, 62, 60)) ^ (1 << rng.integers(0, 62, 60)) for i in range(12)]))
    a, b = simhash.forest(values, np.zeros(len(values)))
    want = brute_components(values.tolist())
    links = dict(zip(a.tolist(), b.tolist()))
    assert len(links) == len(values) - len(set(want.values()))
    assert {v: links.get(v, v) for v in values.tolist()} == want


def test_links_of_a_bucket_cut_into_chunks(spark):
    rng = random.Random(5)
    values = sorted({7 ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(400)})
    values = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in values], "fp LONG")
    found = components(simhash.links(fps, chunk=16))
    roots = {r.node: r.root for r in found.collect()}
    want = brute_components([v % (1 << 64) for v in values])
    groups = lambda m: sorted(sorted(k % (1 << 64) for k in m if m[k] == r) for r in set(m.values()))
    assert groups({v: roots.get(v, v) for v in values}) == groups(want)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a LONG, b LONG")).collect()}
    assert found == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1200)}


def test_near_groups(edges, spark, small):
    docs = table(spark, small, "documents").select("doc_id", "text")
    noisy = docs.where("doc_id % 5 = 0").select(F.col("doc_id") + 100_000, F.concat("text", F.lit(" tail")))
    for source in (edges, docs.union(noisy)):
        df, key = keyed(source, "t")
        rows = [(r[key], r.doc_id, r.text) for r in df.collect()]
        found = simhash.near_groups(df, key).collect()
        assert {r.key: (r.fingerprint, r.component_id) for r in found} == brute_near(rows)
        assert len(found) == len(rows)
    kept = simhash.keep_leaders(df, key)
    assert kept.columns == df.columns and kept.count() == len({r.first_key for r in found})


def test_near_empty(empty):
    assert simhash.near_groups(empty.withColumn("key", F.lit(1)), "key").count() == 0
