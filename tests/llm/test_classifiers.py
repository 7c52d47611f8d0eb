"""Quality, toxicity and language: identities, held-out accuracy, edge cases."""

import numpy as np
from pyspark.sql import functions as F

from stratalake.llm import language, quality, toxicity
from stratalake.llm.common import bounded_per_group, fold_is, one_per_id, table

SF = "/root/testdata/sf0.01"


def test_pairwise_sum_in_linear_time():
    rng = np.random.default_rng(0)
    m = quality.Machine(None, None, None, 0.3, rng.normal(size=50), rng.normal(size=(50, quality.FACTORS)))
    index, value = rng.choice(50, 12, replace=False), rng.normal(size=12)
    raw, _ = m.raw(np.zeros(12, int), index, value, 1)
    pairs = sum(m.v[index[i]] @ m.v[index[j]] * value[i] * value[j] for i in range(12) for j in range(i))
    assert np.isclose(raw[0], 0.3 + m.w[index] @ value + pairs)


def test_folds(spark):
    import zlib

    rows = spark.range(200).select("id", fold_is(F.col("id"), 5, 0).alias("a"), fold_is(F.col("id"), 3, 1).alias("b")).collect()
    assert all(r.a == (zlib.crc32(str(r.id).encode()) % 5 == 0) and r.b == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)


def test_quality_on_held_out_rows(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = quality.assess(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = [r.predicted == r.quality for r in rows]
    assert len(rows) > 50 and sum(right) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_edges(spark, edges, empty):
    labels = table(spark, SF, "labels")
    some = spark.createDataFrame([(1, 1), (3, 0), (8, 1), (8, None), (None, 1), (7, 0)], "doc_id LONG, quality INT")
    assert quality.assess(edges, some).count() == edges.count()
    constant = quality.assess(edges, some.where("quality = 1")).collect()
    assert {r.score for r in constant} == {1.0}
    assert {r.score for r in quality.assess(edges, labels.where("false")).collect()} == {0.5}
    assert quality.assess(empty, labels).count() == 0


def test_an_id_with_most_rows_is_one_training_row(spark):
    hot = spark.range(0, 30_000, 1, 8).select(F.lit(1).alias("id"), F.concat(F.lit("text "), F.col("id") % 50).alias("body"), F.lit(3).alias("k"))
    rest = spark.createDataFrame([(2, None, 1), (2, "b", 1), (3, "", 2), (3, "", 2), (4, "x", 5)], hot.schema.simpleString()[7:-1].replace(":", " "))
    found = one_per_id(hot.unionByName(rest), "id", "body").collect()
    assert sorted((r.id, r.k) for r in found) == [(1, 3), (2, 1), (3, 2), (4, 5)]
    again = one_per_id(rest.unionByName(hot).repartition(3), "id", "body").collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, again), key=str)


def test_a_rare_group_keeps_all_its_rows(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 1000 == 0, "rare").when(F.col("id") % 3 == 0, "mid").otherwise("big").alias("lang"))
    counts = {r.lang: r["count"] for r in bounded_per_group(rows, F.col("lang"), F.col("id"), 1000).groupBy("lang").count().collect()}
    assert counts["rare"] == 20 and all(850 < counts[g] < 1150 for g in ("mid", "big"))
    assert bounded_per_group(rows.where("false"), F.col("lang"), F.col("id"), 1000).count() == 0


def test_risk_equals_a_text_by_text_sum():
    rng = np.random.default_rng(4)
    prior, k = 0.2, 6
    for n, m in ((5, 40), (3, 0), (1, 7)):
        texts = [[rng.choice(k, rng.integers(0, k), replace=False) for _ in range(size)] for size in (n, m)]
        sides = [(*toxicity.joined(t), len(t)) for t in texts]

        def direct(theta):
            score = [[sum(theta[i] for i in t) + theta[k] for t in side] for side in texts]
            mean = lambda side, sign: sum(np.log1p(np.exp(-sign * g)) for g in side) / len(side) if side else 0.0
            return prior * mean(score[0], 1), mean(score[1], -1) - prior * mean(score[0], -1)

        theta = rng.normal(size=k + 1)
        cost, negative, rise, move = toxicity.risk(theta, *sides, prior)
        assert np.allclose((cost, negative), direct(theta))
        for i, step in enumerate(np.eye(k + 1) * 1e-6):
            up, down = direct(theta + step), direct(theta - step)
            assert np.allclose((rise[i], move[i]), [(a - b) / 2e-6 for a, b in zip(up, down)], atol=1e-6)


def test_risk_estimator_finds_the_marks():
    rng = np.random.default_rng(2)
    clean = lambda: rng.choice(2000, 30, replace=False) + 100
    toxic = lambda: np.concatenate([clean(), rng.choice(5, 2, replace=False)])
    unlabelled = [toxic() if rng.random() < 0.1 else clean() for _ in range(2000)]
    model = toxicity.fit([toxic() for _ in range(200)], unlabelled, 0.1)
    assert set(range(5)) <= set(model.weights) and len(model.weights) < 30
    assert model.bias < 0 < min(model.weights[i] for i in range(5))


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held = labels.where(fold_is(F.col("doc_id"), 3, 1)).select("doc_id")
    model = toxicity.train(docs, labels, fold_is(F.col("doc_id"), 3, 1))
    rows = docs.join(held, "doc_id").join(labels, "doc_id").select("text", "toxic").collect()
    found = [(r.toxic, model.score(r.text) >= 0.7) for r in rows]
    toxic, clean = [p for t, p in found if t], [p for t, p in found if not t]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.05 * len(clean)


def test_toxicity_edges(spark, edges, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)] + [(None, 1)], "doc_id LONG, toxic INT")
    rows = toxicity.assess(edges, labels).collect()
    assert len(rows) == edges.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in toxicity.assess(edges, labels.where("toxic = 0")).collect()} == {0.0}
    assert toxicity.assess(empty, labels).count() == 0


def brute_vector(text):
    """One trigram after the other."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    line = [0, *[ord(c) for c in " ".join(words).replace(" ", "\0")], 0]
    total = np.zeros(language.DIMENSIONS)
    for a, b, c in zip(line, line[1:], line[2:]):
        total += np.roll(language.letter(a), 2).astype(int) * np.roll(language.letter(b), 1) * language.letter(c)
    return total


def test_bundles_are_sums_of_trigram_vectors():
    for text in ("Hello, big world", "Ünï cödé 12 x", "a"):
        assert np.allclose(language.Bundler().encode(text), brute_vector(text))
    assert language.Bundler().encode("12 !") is None and language.Bundler().encode(None) is None


def test_language_on_held_out_rows(spark):
    docs = table(spark, SF, "documents")
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 100 and sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(edges, empty):
    rows = language.identify(edges).collect()
    texts = [r.text for r in edges.collect()]
    assert len(rows) == len(texts)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in t or "")) for r, t in zip(rows, texts))
    assert language.identify(empty).count() == 0
    assert {r.lang_pred for r in language.identify(edges.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
