from types import SimpleNamespace

import pytest
from support_core import plan
from pyspark.sql import functions as F

from stratalake.operators import layout, sinks
from stratalake.operators.caching import LEVELS, kept
from stratalake.operators.clustered import ClusteredParquet
from stratalake.session import ADAPTIVE, apply_adaptive, scratch_path, shared_dir


def test_partition_spread_counts_empty_partitions(spark):
    df = spark.range(100).select(F.lit(1).alias("k"), "id")
    one = layout.partition_spread(layout.hash_layout(df, 10, "k"), 10).first()
    assert (one["partitions"], one["max_rows"], one["min_rows"], one["skew"]) == (10, 100, 0, 100)
    even = layout.partition_spread(layout.range_layout(df, 4, "id"), 4).first()
    assert even["skew"] < 30


def test_compaction_keeps_rows(spark, path):
    spark.range(1000).repartition(20).write.parquet(f"{path}/small")
    assert layout.file_count(spark, f"{path}/small") == 20
    assert layout.compact(spark, f"{path}/small", f"{path}/large") == 1
    assert spark.read.parquet(f"{path}/large").agg(F.sum("id")).first()[0] == 499500


def test_clustering_touches_fewer_files(spark, path):
    df = spark.range(20000).select(
        (F.col("id") * 7919 % 1000).alias("a"), (F.col("id") * 104729 % 997).alias("b"), F.col("id").alias("v")
    )
    df.repartition(16).write.parquet(f"{path}/plain")
    layout.cluster(df, ["a", "b"], 16).write.parquet(f"{path}/clustered")

    def touched(where, column, value):
        stats = layout.file_stats(spark, f"{path}/{where}", column)
        return stats.where((F.col(f"min_{column}") <= value) & (F.col(f"max_{column}") >= value)).count()

    for column in ("a", "b"):
        assert touched("plain", column, 500) == 16
        assert touched("clustered", column, 500) <= 8
    clustered = spark.read.parquet(f"{path}/clustered")
    assert clustered.count() == 20000 and clustered.exceptAll(df).isEmpty()


def test_compacting_one_partition_leaves_the_others(spark, path):
    df = spark.range(300).select("id", (F.col("id") % 3).alias("d"))
    df.repartition(8).write.partitionBy("d").parquet(f"{path}/t")
    before = {r["file"] for r in layout.file_stats(spark, f"{path}/t").collect()}
    layout.compact_partition(spark, f"{path}/t", "d", 1, ["id"])
    after = {r["file"] for r in layout.file_stats(spark, f"{path}/t").collect()}
    assert len([f for f in after if "d=1" in f]) == 1
    assert {f for f in before if "d=1" not in f} == {f for f in after if "d=1" not in f}
    assert spark.read.parquet(f"{path}/t").count() == 300


@pytest.mark.parametrize("level", LEVELS)
def test_cache_is_released(spark, level):
    df = spark.range(100).withColumn("value", F.col("id") * 2)
    with kept(df, level) as cached:
        assert cached.count() == 100 and cached.is_cached
    assert not df.is_cached
    with pytest.raises(RuntimeError), kept(df, level):
        raise RuntimeError
    assert not df.is_cached


def test_session_settings(spark):
    for key, value in ADAPTIVE.items():
        assert spark.conf.get(key) == value
    assert apply_adaptive(spark, **{"spark.sql.adaptive.skewJoin.skewedPartitionFactor": "7"})[
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor"
    ] == "7"
    apply_adaptive(spark)


def test_scratch_follows_the_checkpoint_setting(spark, path):
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: {"spark.checkpoint.dir": f"{path}/"}.get(key)))
    assert shared_dir(named) == path and scratch_path(named, "x").startswith(f"{path}/x-")
    # a session that names none agrees with itself
    assert shared_dir(spark) == shared_dir(spark)


def test_join_switches_to_broadcast_at_run_time(spark, path):
    spark.range(200000).select((F.col("id") % 500).alias("k"), "id").write.parquet(f"{path}/fact")
    spark.range(100000).select("id").write.parquet(f"{path}/dim")
    fact, dim = spark.read.parquet(f"{path}/fact"), spark.read.parquet(f"{path}/dim")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        small = dim.where("id % 1000 = 7").select(F.col("id").alias("k"))
        joined = fact.join(small, "k").groupBy("k").count()
        assert "SortMergeJoin" in plan(joined, "simple")
        joined.collect()
        final = plan(joined, "simple").split("Initial Plan")[0]
        assert "BroadcastHashJoin" in final and "AQEShuffleRead" in final
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_k_and_noop(spark):
    top = spark.range(1000).orderBy(F.desc("id")).limit(5)
    assert "TakeOrderedAndProject" in plan(top, "simple")
    sinks.discard(top)
    assert "Range" in plan(top, "extended") and "Parsed Logical Plan" in plan(top, "extended")


def test_approximate_distinct_and_percentile_stay_close(spark):
    df = spark.range(50_000).select((F.col("id") * 7919 % 9973).alias("k"), F.col("id").alias("v"))
    got = df.agg(
        F.approx_count_distinct("k", 0.02).alias("n"), F.percentile_approx("v", 0.95, 10_000).alias("p95")
    ).first()
    assert abs(got["n"] - 9973) < 0.06 * 9973
    assert abs(got["p95"] - 47_500) <= 10


def test_compaction_of_a_partition_with_an_odd_name(spark, path):
    df = spark.range(100).select("id", F.when(F.col("id") % 2 == 0, "a b/c=%").otherwise("x").alias("d"))
    df.repartition(4).write.partitionBy("d").parquet(f"{path}/t")
    layout.compact_partition(spark, f"{path}/t", "d", "a b/c=%", ["id"])
    assert spark.read.parquet(f"{path}/t").where("d = 'a b/c=%'").count() == 50 and spark.read.parquet(f"{path}/t").count() == 100


def test_hilbert_curve_steps_from_cell_to_neighbour(spark):
    bits, side = 4, 16
    cells = spark.range(side * side).select((F.col("id") % side).alias("x"), (F.col("id") / side).cast("int").alias("y"))
    at = {r["d"]: (r["x"], r["y"]) for r in layout.with_hilbert(cells, "x", "y", bits, "d").collect()}
    assert sorted(at) == list(range(side * side)) and at[0] == (0, 0)
    assert all(abs(at[i][0] - at[i + 1][0]) + abs(at[i][1] - at[i + 1][1]) == 1 for i in range(side * side - 1))


def test_bounds_of_a_clustering_do_not_grow_with_the_files(spark):
    df = spark.range(50_000).select(F.col("id").alias("a"), (F.col("id") * 7919 % 50_021).alias("b"))
    assert all(len(b) < layout.MOST_RANKS for b in layout.cluster_bounds(df, ["a", "b"], 400_000).values())


def test_a_load_rewrites_only_the_files_it_overlaps(spark, path):
    df = spark.range(24_000).select(F.col("id").alias("day"), (F.col("id") * 7919 % 997).alias("item"), F.col("id").cast("string").alias("v"))
    table = ClusteredParquet(spark, f"{path}/t", ["day", "item"], 1_000)
    first = table.create(df.where("day < 20000"))
    assert first >= 18
    before = {r["name"] for r in table.files().collect()}
    done = table.load(df.where("day >= 20000"))  # the newest days touch one edge of the square
    after = {r["name"] for r in table.files().collect()}
    assert done.rows == 4_000 and done.files_untouched >= 0.6 * first
    assert len(before & after) == done.files_untouched and len(before - after) == done.files_rewritten
    assert table.read().exceptAll(df).isEmpty() and table.read().count() == 24_000
    assert table.load(df.limit(0)) == type(done)(0, 0, len(after))
    again = table.load(df.where("day = 17"))  # one row: the files around it
    assert again.rows == 1 and again.files_rewritten <= 3 and table.read().count() == 24_001


def test_nulls_and_unlisted_files_in_a_clustered_table(spark, path):
    df = spark.range(3_000).select(F.when(F.col("id") % 5 > 0, F.col("id") % 77).alias("a"), F.col("id").cast("string").alias("b"))
    table = ClusteredParquet(spark, f"{path}/t", ["a", "b"], 300)
    table.create(df)
    df.limit(10).coalesce(1).write.mode("append").parquet(f"{path}/t")  # a file without an entry
    assert table.files().agg(F.sum("n")).first()[0] == 3_010
    table.load(df.where("a is null"))
    assert table.read().count() == 3_610 and table.read().where("a is null").count() >= 1_200
    assert table.files().where("first > last").isEmpty()


def test_bloom_filters_skip_row_groups(spark, path):
    df = spark.range(40_000).select((F.col("id") * 2).alias("k"), "id").repartition(8)
    df.write.option("parquet.enable.dictionary", "false").parquet(f"{path}/plain")
    df.write.options(**layout.bloom_options({"k": 5_000}, 0.001)).parquet(f"{path}/bloom")

    def scanned(name, key):
        return layout.rows_scanned(spark.read.parquet(f"{path}/{name}").where(F.col("k") == key))

    assert scanned("plain", 40_001) == (0, 40_000)
    assert scanned("bloom", 40_001)[0] == 0 and scanned("bloom", 40_001)[1] <= 5_000
    found, read = scanned("bloom", 40_000)
    assert found == 1 and read <= 10_000
