"""Erasure rewrites the files that hold a subject and no others."""

import pytest
from pyspark.sql import functions as F

from stratalake.filesystem import Files
from stratalake.operators import erasure, rewrite


def table(spark, root, folders=()):
    rows = spark.range(400).select((F.col("id") % 100).alias("k"), F.col("id").alias("v"), F.when(F.col("id") % 100 < 50, "a").otherwise("b").alias("part"))
    rows = rows.unionByName(spark.createDataFrame([(None, -1, "a")], "k LONG, v LONG, part STRING"))
    rows.repartitionByRange(10, "k").write.partitionBy(*folders).parquet(root)
    return rows


def subjects(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "k INT")


def names(spark, root):
    return set(Files(spark).below(root))


@pytest.mark.parametrize("folders", [(), ("part",)])
def test_only_files_with_subjects_change(spark, path, folders):
    rows, root = table(spark, f"{path}/t", folders), f"{path}/t"
    before = names(spark, root)
    held = {r.file.rsplit("/", 1)[1] for r in erasure.files_holding(spark.read.parquet(root), "k", subjects(spark, 3, 4, 97)).collect()}
    report = erasure.erase(spark, root, "k", subjects(spark, 3, 4, 4, 97, None, 12345))
    after = names(spark, root)
    assert report.rows_erased == 12 and report.files_rewritten == len(held) and report.files_untouched == len(before) - len(held) > 0
    assert before & after == {n for n in before if n.rsplit("/", 1)[-1] not in held}
    left = spark.read.parquet(root)
    want = rows.where("k IS NULL OR k NOT IN (3, 4, 97)")
    assert left.count() == 389 and left.select("k", "v", "part").exceptAll(want).isEmpty() and want.exceptAll(left.select("k", "v", "part")).isEmpty()
    assert Files(spark).children(f"{root}/{rewrite.WORK}") == []


def test_nothing_to_erase(spark, path):
    table(spark, f"{path}/t")
    before = names(spark, f"{path}/t")
    assert erasure.erase(spark, f"{path}/t", "k", subjects(spark, 1234)) == erasure.Report(0, 0, len(before))
    assert erasure.erase(spark, f"{path}/t", "k", subjects(spark).where("false")).rows_erased == 0
    assert names(spark, f"{path}/t") == before


def test_files_with_nothing_else_vanish(spark, path):
    spark.range(10).withColumnRenamed("id", "k").repartitionByRange(5, "k").write.parquet(f"{path}/t")
    assert erasure.erase(spark, f"{path}/t", "k", subjects(spark, *range(10))).rows_erased == 10
    assert spark.read.schema("k LONG").parquet(f"{path}/t").count() == 0


@pytest.mark.parametrize("stop", ["listing", "first delete", "moves"])
def test_an_interrupted_erasure_is_finished_or_forgotten(spark, path, monkeypatch, stop):
    rows, root = table(spark, f"{path}/t", ("part",)), f"{path}/t"
    real, calls = Files.delete, []

    def fail(*_):
        raise RuntimeError("lost")

    def second(self, name):
        calls.append(name)
        return real(self, name) if len(calls) < 2 else fail()

    if stop == "listing":
        monkeypatch.setattr(rewrite, "_finish", fail)
    elif stop == "first delete":
        monkeypatch.setattr(Files, "delete", second)
    else:
        monkeypatch.setattr(Files, "move", fail)
    with pytest.raises(RuntimeError):
        erasure.erase(spark, root, "k", subjects(spark, 3, 50, 97))
    monkeypatch.undo()
    if stop == "listing":  # as if the list had not been written either
        work = Files(spark).children(f"{root}/{rewrite.WORK}")[0]
        real(Files(spark), f"{root}/{rewrite.WORK}/{work}/old/_SUCCESS")
    rewrite.recover(spark, root)
    gone = () if stop == "listing" else (3, 50, 97)
    want = rows.where(~F.coalesce(F.col("k").isin(*gone), F.lit(False))) if gone else rows
    left = spark.read.parquet(root).select("k", "v", "part")
    assert left.count() == want.count() and left.exceptAll(want).isEmpty()
    assert erasure.erase(spark, root, "k", subjects(spark, 3, 50, 97)).rows_erased == (12 if stop == "listing" else 0)
