"""The mix: targets, closeness, edge cases; the query itself is compared with its SQL."""

import pytest

from stratalake.llm import mixing
from stratalake.llm.common import staged, table


def fill(sizes, volume=1.5, weights=(5, 2, 1)):
    """Targets by repeated resharing, as the rule is worded."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, targets, open_ = volume * sum(sizes.values()), {}, list(names)
    while open_:
        rest = total - sum(targets.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return targets | share
        targets |= {s: 2.0 * sizes[s] for s in over}
        open_ = [s for s in open_ if s not in over]
    return targets


def test_targets_follow_the_rule(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 500, None: 70}, {"a": 5}, {"a": 0, "b": 9}, {"é": 40, "z": 40, "Z": 40, "k": 7000}):
        rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source STRING, size LONG")
        found = {r.source: r.target for r in mixing.source_targets(rows).collect()}
        assert found == pytest.approx(fill(sizes))


def test_taken_words_come_near_the_targets(spark):
    rows = staged(mixing.sized_rows(table(spark, "/root/testdata/sf0.01", "documents")), "t")
    first = mixing.mixed(rows).collect()
    per = {}
    for r in first:
        assert r.taken == r.copies * r["size"] <= 2 * r["size"]
        per.setdefault(r.source, [r.target, 0])[1] += r.taken
    assert all(abs(taken - target) <= 0.02 * target for target, taken in per.values())
    again = {(r.doc_id, r.taken) for r in mixing.mixed(rows.repartition(5)).collect()}
    assert again == {(r.doc_id, r.taken) for r in first}


def test_edges(edges, empty):
    rows = mixing.mixed(staged(mixing.sized_rows(edges), "t")).collect()
    assert len(rows) == edges.count()
    assert all(r.taken == 0 for r in rows if r["size"] == 0) and all(r.copies in (0, 1, 2) for r in rows)
    assert {r.source for r in rows} == {"s1", "s2", "s3", None}
    assert mixing.mixed(staged(mixing.sized_rows(empty), "t")).count() == 0


def test_size_decides_the_odds(spark):
    """Longer documents are likelier to be drawn: inclusion goes with the root of the size."""
    docs = spark.createDataFrame([(i, "w " * (4 if i % 2 else 64), "s") for i in range(3000)], "doc_id LONG, text STRING, source STRING")
    docs = docs.union(spark.createDataFrame([(9000 + i, "w " * 1000, "t") for i in range(400)], "doc_id LONG, text STRING, source STRING"))
    rows = mixing.mixed(staged(mixing.sized_rows(docs), "t"), weights=(1, 20), volume=0.9).collect()
    drawn = {n: sum(r.copies for r in rows if r.source == "s" and r["size"] == n) for n in (4, 64)}
    assert 0 < drawn[4] < drawn[64]


def taken(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING").repartition(6)
    return mixing.mixed(staged(mixing.sized_rows(docs), "t"), **options).collect()


def test_repeated_rows_are_drawn_one_by_one(spark):
    """One id and text a hundred times: every multiple of its size can be reached."""
    word = "w " * 10
    rows = taken(spark, [(1, word, "s")] * 100 + [(2, "x " * 2000, "t")], weights=(1, 20), volume=0.75)
    own = [r for r in rows if r.source == "s"]
    assert len(rows) == 101 and abs(sum(r.taken for r in own) - own[0].target) < 10 and sorted({r.copies for r in own}) in ([0, 1], [1], [0])
    rows = taken(spark, [(1, word, "s")] * 100)
    assert sum(r.taken for r in rows) == 1500 and sorted({r.copies for r in rows}) == [1, 2]
    again = taken(spark, [(1, word, "s")] * 100)
    assert sorted(r.copies for r in again) == sorted(r.copies for r in rows)


def test_equal_rows_are_numbered_within_their_source(spark, edges):
    docs = spark.createDataFrame([(i % 3 or None, "ab"[i % 2], "s" if i % 5 else None, i % 7) for i in range(300)], "doc_id LONG, text STRING, source STRING, part INT")
    found = mixing.numbered(docs.repartition(7), "no")
    assert found.columns == [*docs.columns, "no"] and found.drop("no").exceptAll(docs).isEmpty() and found.count() == 300
    groups = {}
    for r in found.collect():
        groups.setdefault((r.doc_id, r.text, r.source), []).append(r.no)
    assert all(sorted(g) == list(range(len(g))) for g in groups.values())
    assert mixing.numbered(edges, "no").where("no > 0").count() == 1


def test_documents_that_must_be_taken_are_certain(spark):
    """Large documents whose measure would be above one come first, and the rest is scaled anew."""
    docs = [(i, "w " * (5000 if i < 4 else 10), "s") for i in range(1000)] + [(5000 + i, "w " * 1000, "t") for i in range(30)]
    rows = spark.createDataFrame(docs, "doc_id LONG, text STRING, source STRING")
    sized = staged(mixing.sized_rows(rows), "t")
    plan = mixing.plan_mix(sized, weights=(1, 1), volume=0.9).where("source = 's'").first()
    assert plan.scale * 5000**0.5 >= 1 > plan.scale * 10**0.5
    inclusion = [min(1, plan.scale * n**0.5) * n for n in [5000] * 4 + [10] * 996]
    assert abs(sum(inclusion) - plan.rest) < 1e-6
    found = [r for r in mixing.mixed(sized, weights=(1, 1), volume=0.9).collect() if r["size"] == 5000]
    assert [r.copies - plan.whole for r in found] == [1] * 4
