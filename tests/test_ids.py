"""Surrogate ids: contiguous, unique, in order - also with one hot key."""

import re

import pytest
from pyspark.sql import functions as F

from tideline.operators.ids import natural_order, surrogate_ids
from tideline.session import fresh_path
from tideline.sources.csvfiles import read_csv_dataset


def test_key_order_with_a_hot_key(spark):
    n = 3000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                               F.col("id").alias("v"))
    out = surrogate_ids(df, fresh_path(spark, "test_ids"), order_by=["k"], num_partitions=6)
    rows = out.collect()
    ids = sorted(r.id for r in rows)
    assert ids == list(range(1, n + 1))
    by_id = sorted(rows, key=lambda r: r.id)
    keys = [r.k for r in by_id]
    assert keys == sorted(keys)


def test_input_order_without_shuffle(spark, tmp_path):
    path = str(tmp_path / "d.csv")
    spark.range(500).select(F.col("id").cast("string").alias("x")).repartition(3) \
        .write.option("header", True).csv(path)
    text = read_csv_dataset(spark, path, with_position=True)
    import glob
    expected = []
    for f in sorted(glob.glob(f"{path}/part-*.csv")):   # input order: files by name, lines in order
        expected += [line.strip() for line in open(f).readlines()[1:]]
    out = surrogate_ids(text, fresh_path(spark, "test_ids_in"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the rows meet the per-split offsets in a broadcast join: they are never shuffled
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    got = [r.x for r in sorted(out.collect(), key=lambda r: r.id)]
    assert got == expected


def test_two_level_prefix_offsets(spark):
    from tideline.operators.ids import prefix_offsets
    stats = spark.range(1, 2001).select(F.col("id").alias("g"), (F.col("id") % 7 + 1).alias("n"))
    out = {r.g: r._off for r in prefix_offsets(stats, ["g"], "n", fresh_path(spark, "pfx"), ranges=5).collect()}
    run, expect = 0, {}
    for g in range(1, 2001):
        expect[g] = run
        run += g % 7 + 1
    assert out == expect


def test_rows_removed_from_inside_a_split_are_refused(spark, tmp_path):
    path = str(tmp_path / "d.csv")
    spark.range(20).coalesce(1).write.option("header", True).csv(path)
    text = read_csv_dataset(spark, path, with_position=True).where("id % 2 = 0").withColumnRenamed("id", "x")
    with pytest.raises(ValueError):
        surrogate_ids(text, fresh_path(spark, "test_ids_gap"))


def test_paths_sort_by_their_numbers(spark):
    names = ["d/part-99999-a", "d/part-100000-a", "d/part-2", "d/part-10", "c9/part-1", "c10/part-0"]
    rows = spark.createDataFrame([(n,) for n in names], "p string").orderBy(natural_order(F.col("p"))).collect()
    assert [r.p for r in rows] == ["c9/part-1", "c10/part-0", "d/part-2", "d/part-10", "d/part-99999-a",
                                   "d/part-100000-a"]


def test_more_files_than_cores_and_no_rows(spark, tmp_path):
    path = str(tmp_path / "many.csv")
    spark.range(300).select(F.col("id").alias("x")).repartitionByRange(23, "x").sortWithinPartitions("x") \
        .write.option("header", True).csv(path)
    text = read_csv_dataset(spark, path, with_position=True)
    out = surrogate_ids(text, fresh_path(spark, "test_ids_many"))
    assert out.where("id <> x + 1").count() == 0 and out.count() == 300
    assert surrogate_ids(text.where("false"), fresh_path(spark, "test_ids_none")).count() == 0


def test_ranges_grow_with_the_size_of_the_data(spark, monkeypatch):
    from tideline.operators import ids
    df = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    assert ids.range_count(df) is None                 # the session's number is enough
    monkeypatch.setattr(ids, "RANGE_BYTES", 1 << 20)
    big = df.join(df.select("o_custkey"), "o_custkey")   # estimated as a product
    assert (ids.range_count(big) or 0) < 100
    assert ids.range_count(spark.sparkContext.parallelize([(1,)]).toDF(["x"])) is None
    counts = []
    for size in (40_000, 10_000):
        monkeypatch.setattr(ids, "RANGE_BYTES", size)
        counts.append(ids.by_ranges(df, ["o_orderkey"]).rdd.getNumPartitions())
    assert counts[0] > 4 and 3 * counts[0] <= counts[1] <= 4 * counts[0]
    assert surrogate_ids(df.select("o_orderkey"), fresh_path(spark, "test_ids_ranges"), order_by=["o_orderkey"]) \
        .agg(F.max("id")).first()[0] == df.count()
