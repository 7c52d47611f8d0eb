"""Nearest vectors: exact against numpy, hashed against exact."""

import numpy as np
from pyspark.sql import functions as F
from support_core import plan

from stratalake.operators import vectors


def table(spark, matrix, extra=()):
    rows = [(i, v.tolist()) for i, v in enumerate(matrix)] + list(extra)
    return spark.createDataFrame(rows, "id LONG, vec ARRAY<FLOAT>").repartition(5)


def clustered(n, dim, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((20, dim))
    return (centres[rng.integers(0, 20, n)] + 0.6 * rng.standard_normal((n, dim))).astype(np.float32)


def brute(matrix, ids, k):
    unit = matrix.astype(float) / np.linalg.norm(matrix.astype(float), axis=1)[:, None]
    out = set()
    for q in ids:
        s = np.round(unit @ unit[q], 9)
        order = [j for j in np.lexsort((np.arange(len(s)), -s)) if j != q][:k]
        out |= {(q, r + 1, int(j), float(s[j])) for r, j in enumerate(order)}
    return out


def test_exact(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    matrix = clustered(150, 8)
    matrix[50:60] = matrix[0]  # ties
    odd = [(900, None), (901, []), (902, [0.0] * 8), (903, [1.0, 2.0]), (904, [float("nan")] * 8), (905, [None] * 8), (None, [1.0] * 8)]
    df = table(spark, matrix, odd)
    asked = df.where("id % 10 = 0 OR id > 899")
    found = {(r.query_id, r["rank"], r.id, round(r.similarity, 9)) for r in vectors.exact_top_k(df, asked, 7).collect()}
    want = brute(matrix, range(0, 150, 10), 7)
    assert {f[:3] for f in found} == {w[:3] for w in want}
    assert np.allclose(sorted(f[3] for f in found), sorted(w[3] for w in want), atol=1e-8)


def test_fewer_than_k_and_empty(spark):
    df = table(spark, clustered(3, 4))
    assert vectors.exact_top_k(df, df, 10).count() == 6
    assert vectors.lsh_top_k(df, df, 10, bits=1).count() <= 6
    none = df.where("false")
    assert vectors.exact_top_k(none, df, 3).count() == vectors.exact_top_k(df, none, 3).count() == vectors.lsh_top_k(none, df, 3).count() == 0


def test_probes_cross_the_nearest_planes():
    rng = np.random.default_rng(5)
    matrix = rng.standard_normal((40, 6))
    planes = vectors.Planes(3, 5, 7)
    own, probed = planes.buckets(matrix, False), planes.buckets(matrix, True)
    assert probed.shape == (40, 3, 8) and (probed[:, :, 0] == own[:, :, 0]).all()
    assert (probed >> 5 == np.arange(3)[:, None]).all()
    assert all(len(set(row)) == 8 for rows in probed.tolist() for row in rows)
    side = planes._products(matrix)
    crossed = np.bitwise_xor(probed[:, :, 1], own[:, :, 0])
    assert (crossed == 1 << np.abs(side).argmin(axis=2)).all()


def test_hashed_search_finds_nearly_all_and_compares_few(spark):
    matrix = clustered(4000, 32, 1)
    df = table(spark, matrix)
    asked = df.where("id % 100 = 0")
    found = vectors.lsh_top_k(df, asked, 10)
    exact = vectors.exact_top_k(df, asked, 10)
    row = vectors.recall(found, exact).first()
    assert row.neighbours == 400 and row.recall >= 0.9
    got = {(r.query_id, r.id): r.similarity for r in found.collect()}
    want = {(r.query_id, r.id): r.similarity for r in exact.collect()}
    assert all(abs(got[p] - want[p]) < 1e-8 for p in got.keys() & want.keys())
    text = plan(found, "simple")
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_a_bucket_of_a_third_of_all_vectors_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 32)
    matrix = clustered(900, 8, 2)
    matrix[::3] = matrix[0] * (1 + np.arange(300)[:, None])  # one direction
    df = table(spark, matrix)
    asked = df.where(F.col("id").isin(0, 3, 1))
    found = vectors.lsh_top_k(df, asked, 5).where("query_id % 3 = 0").orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.id) for r in found] == [(0, i) for i in (3, 6, 9, 12, 15)] + [(3, i) for i in (0, 6, 9, 12, 15)]
