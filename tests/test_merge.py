from datetime import datetime, timedelta

import pytest
from support_core import rows
from pyspark.sql import functions as F

from stratalake.filesystem import Files
from stratalake.operators import merge
from stratalake.operators.keyed import KeyedParquet
from stratalake.plans import loads


def frame(spark, data, schema="id INT, v STRING"):
    return spark.createDataFrame(data, schema)


def test_upsert_and_its_repetition(spark):
    target, source = frame(spark, [(1, "a"), (2, "b"), (None, "n")]), frame(spark, [(2, "B"), (3, "C"), (None, "N")])
    once = merge.merge_upsert(target, source, ["id"])
    # NULL keys match nothing
    assert rows(once) == sorted([(1, "a"), (2, "B"), (3, "C"), (None, "n"), (None, "N")], key=repr)
    keyed = source.dropna()
    assert rows(merge.merge_upsert(once.dropna(), keyed, ["id"])) == rows(once.dropna())


def test_duplicate_source_keys_are_refused(spark):
    with pytest.raises(merge.DuplicateSourceKeys):
        merge.merge_upsert(frame(spark, [(1, "a")]), frame(spark, [(2, "x"), (2, "y")]), ["id"])


def test_insert_only_and_update_where(spark):
    target = frame(spark, [(1, "a")])
    assert rows(merge.merge_insert_only(target, frame(spark, [(1, "z"), (2, "b")]), ["id"])) == [(1, "a"), (2, "b")]
    updated = merge.update_where(frame(spark, [(1, "a"), (None, "b")]), F.col("id") > 0, {"v": F.lit("set")})
    assert rows(updated) == [(1, "set"), (None, "b")]


def test_changes_late_rows_lose(spark):
    data = [(1, 5, "new", "x"), (1, 3, "late", "y"), (2, 1, "only", "z"), (1, 5, "a-tie", "x")]
    df = frame(spark, data, "id INT, seq INT, v STRING, drop_me STRING")
    got = merge.apply_changes(df, ["id"], "seq", ["seq", "drop_me"])
    assert rows(got) == [(1, "a-tie"), (2, "only")]


def test_bucket_count_is_stored_and_untouched_buckets_stay(spark, path):
    table = KeyedParquet(spark, f"{path}/t", ["id"], bucket_bytes=100)
    assert not table.exists()
    table.overwrite(frame(spark, [(i, "old") for i in range(200)]))
    stored = spark.read.parquet(f"{path}/t")
    files = {f for f in stored.inputFiles()}
    assert stored.select("key_buckets").distinct().count() == 1 and stored.select("key_bucket").distinct().count() > 4
    # another handle with another idea of the bucket size
    KeyedParquet(spark, f"{path}/t", ["id"]).merge(frame(spark, [(7, "new"), (1000, "added")]))
    assert table.read().count() == 201
    assert rows(table.read().where("v <> 'old'")) == [(1000, "added"), (7, "new")]
    assert len(files - set(spark.read.parquet(f"{path}/t").inputFiles())) <= 2, "two keys are in two buckets at most"


def test_a_source_that_changes_while_it_is_read(spark, path):
    table = KeyedParquet(spark, f"{path}/t", ["id"], bucket_bytes=2000)
    table.overwrite(frame(spark, [(i, "old") for i in range(1000)]))
    frame(spark, [(5, "x")]).write.parquet(f"{path}/growing")
    source = spark.read.schema("id INT, v STRING").parquet(f"{path}/growing")
    random = source.withColumn("id", (F.rand() * 1000).cast("int"))  # another key per evaluation
    for _ in range(3):
        table.merge(random)
    assert table.read().count() == 1000 and 1 <= table.read().where("v = 'x'").count() <= 3


def test_merge_evolution_duplicates_and_key_types(spark, path):
    table = KeyedParquet(spark, f"{path}/t", ["id"])
    table.overwrite(frame(spark, [(1, "a"), (2, "b")]))
    table.merge(frame(spark, [(2, "B", 5)], "id INT, v STRING, extra INT"))
    assert rows(table.read()) == [(1, "a", None), (2, "B", 5)]
    with pytest.raises(merge.DuplicateSourceKeys):
        table.merge(frame(spark, [(1, "x"), (1, "y")]))
    table.overwrite(frame(spark, [(3, "c")], "id INT, other STRING"))
    assert table.read().columns == ["id", "other"]
    table.merge(frame(spark, [(4, "d")], "id INT, other STRING"))
    assert rows(table.read()) == [(3, "c"), (4, "d")]


def test_changes_across_batches_feeds_and_replays(spark, path):
    table = KeyedParquet(spark, f"{path}/t", ["id"])
    schema = "id INT, seq INT, v STRING"
    first = frame(spark, [(1, 5, "five"), (2, 1, "one")], schema)
    table.apply_changes(first, "seq")
    table.apply_changes(frame(spark, [(1, 4, "late"), (2, 2, "two"), (3, 1, "n")], schema), "seq")
    table.apply_changes(first, "seq")
    assert rows(table.read().drop("seq")) == [(1, "five"), (2, "two"), (3, "n")]


T0 = datetime(2024, 1, 1)


def run_load(spark, path, data, step, overlap=timedelta(0)):
    source = spark.createDataFrame(data, "order_id INT, amount DOUBLE, updated_date TIMESTAMP")
    return loads.incremental_load(
        "sales.orders",
        lambda after: source.where(F.col("updated_date") > F.lit(after)),
        KeyedParquet(spark, f"{path}/orders", ["order_id"]),
        loads.Watermarks(spark, f"{path}/control"),
        "updated_date",
        f"{path}/staging-{step}",
        overlap,
    )


def test_incremental_load(spark, path):
    data = [(1, 10.0, T0), (2, 20.0, T0 + timedelta(hours=1))]
    assert run_load(spark, path, data, 0) == {"rows": 2, "watermark": T0 + timedelta(hours=1)}
    assert run_load(spark, path, data, 1)["rows"] == 0
    data += [(1, 11.0, T0 + timedelta(hours=2)), (3, 30.0, T0 + timedelta(hours=3))]
    assert run_load(spark, path, data, 2) == {"rows": 2, "watermark": T0 + timedelta(hours=3)}
    target = KeyedParquet(spark, f"{path}/orders", ["order_id"]).read().select("order_id", "amount")
    assert rows(target) == [(1, 11.0), (2, 20.0), (3, 30.0)]


def test_incremental_load_overlap_catches_late_commits(spark, path):
    data = [(1, 10.0, T0 + timedelta(hours=2))]
    run_load(spark, path, data, 0)
    data.append((2, 20.0, T0 + timedelta(hours=1)))  # committed late, stamped before the watermark
    assert run_load(spark, path, data, 1)["rows"] == 0
    late = run_load(spark, path, data, 2, overlap=timedelta(hours=2))
    assert late == {"rows": 2, "watermark": T0 + timedelta(hours=2)}
    assert KeyedParquet(spark, f"{path}/orders", ["order_id"]).read().count() == 2


def test_a_run_that_dies_before_the_watermark_is_repeatable(spark, path, monkeypatch):
    data = [(1, 10.0, T0)]
    monkeypatch.setattr(loads.Watermarks, "set", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        run_load(spark, path, data, 0)
    monkeypatch.undo()
    assert run_load(spark, path, data, 1)["rows"] == 1
    assert KeyedParquet(spark, f"{path}/orders", ["order_id"]).read().count() == 1


def test_buckets_grow_with_the_table(spark, path):
    table = KeyedParquet(spark, f"{path}/t", ["id"], bucket_bytes=10_000)
    count = lambda: spark.read.parquet(f"{path}/t").select("key_buckets").distinct().collect()
    row = lambda i: (i, f"{i * 2654435761 % (1 << 32):032x}")  # noqa: E731  text that does not compress away
    table.merge(frame(spark, [row(i) for i in range(100)]))
    assert [r[0] for r in count()] == [1]
    for part in range(1, 5):
        table.merge(frame(spark, [row(i) for i in range(part * 2500, (part + 1) * 2500)]))
    buckets = count()
    assert len(buckets) == 1 and buckets[0][0] > 4
    assert rows(table.read()) == rows(frame(spark, [row(i) for i in [*range(100), *range(2500, 12_500)]]))
    # a merge that does not deal anew leaves the other buckets alone
    before = set(spark.read.parquet(f"{path}/t").inputFiles())
    table.merge(frame(spark, [(3, "x"), (2501, "y")]))
    after = set(spark.read.parquet(f"{path}/t").inputFiles())
    assert 0 < len(before - after) <= 2 < len(before & after)


@pytest.mark.parametrize("grown", [False, True])
def test_a_killed_swap_is_finished(spark, path, monkeypatch, grown):
    """The writer is lost after folders were deleted and before the new ones were moved in."""
    size = 300 if grown else 1000
    table = KeyedParquet(spark, f"{path}/t", ["id"], bucket_bytes=size)
    table.overwrite(frame(spark, [(i, f"old {i * 7919 % 1000}") for i in range(200)]))
    changes = frame(spark, [(i, f"new {i}") for i in range(150, 150 + (2000 if grown else 100))])

    def killed(self, df, mode):
        root = f"{path}/t"
        names = {n.split("/")[1] for n in Files(spark).below(root)}
        for name in sorted(names)[: None if mode == "static" else 3]:
            Files(spark).delete(f"{root}/key_buckets={[n for n in Files(spark).children(root) if '=' in n][0].split('=')[1]}/{name}")
        raise RuntimeError("killed")

    monkeypatch.setattr(KeyedParquet, "_write", killed)
    with pytest.raises(RuntimeError):
        table.merge(changes)
    monkeypatch.undo()
    again = KeyedParquet(spark, f"{path}/t", ["id"], bucket_bytes=size)
    again.merge(frame(spark, [(-1, "later")]))
    want = {i: f"old {i * 7919 % 1000}" for i in range(200)} | {r.id: r.v for r in changes.collect()} | {-1: "later"}
    assert {r.id: r.v for r in again.read().collect()} == want and again.read().count() == len(want)
    assert not Files(spark).exists(f"{path}/t.swap")


def test_a_note_that_is_not_complete_changes_nothing(spark, path):
    table = KeyedParquet(spark, f"{path}/t", ["id"])
    table.overwrite(frame(spark, [(1, "a")]))
    frame(spark, [("/nowhere", "static", 1)], "path STRING, mode STRING, buckets INT").write.json(f"{path}/t.swap")
    Files(spark).delete(f"{path}/t.swap/_SUCCESS")
    table.merge(frame(spark, [(2, "b")]))
    assert rows(table.read()) == [(1, "a"), (2, "b")]
