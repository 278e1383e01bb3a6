"""Contiguous surrogate ids 1..n.

Never a global ``row_number()`` (one task would see every row).  The rows
are staged once in the shared scratch folder with a group (file split or
range partition) and a position inside it; per-group counts (one row per
group) get running totals from a two-level prefix sum in Spark, and the ids
follow from a join on the group.

* input order (``position=``): rows keep the order they had in their files;
  the rows are never shuffled, they meet one (group, shift) row per split.
* key order (``order_by=``): range partitioning on the key plus a
  tie-breaker, so one hot key value spreads over several partitions.

Staging makes the numbering stable: range bounds and split planning are not
recomputed between the counting pass and the numbering pass, and a lost
executor re-reads staged files instead of re-deriving positions."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: (group, shift) rows of 16 bytes that are broadcast, at most (64 MB; a split is
#: up to 128 MB of input); with more groups Spark picks the join.
BROADCAST_GROUPS_MAX = 4_000_000


#: Estimated bytes of a range, at most.
RANGE_BYTES, MOST_RANGES = 128 << 20, 1_000_000
#: Spark's estimate for an input it knows nothing about is beyond this.
UNKNOWN_SIZE = 1 << 60


def range_count(df: DataFrame) -> int | None:
    """Number of ranges that ``df`` needs by the optimizer's estimate of its size,
    but for no more than its inputs together (a join without statistics is
    estimated as a product).  None where the session's number of shuffle
    partitions is enough (adaptive execution only ever merges those), or an
    input's size is not known."""
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    if not sizes or max(sizes) >= UNKNOWN_SIZE:
        return None
    size = min(int(str(plan.stats().sizeInBytes())), sum(sizes))
    need = min(MOST_RANGES, -(-size // RANGE_BYTES))
    return need if need > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def by_ranges(df: DataFrame, by, num_partitions: int | None = None) -> DataFrame:
    """``repartitionByRange`` into the given number of ranges, or as many as the size of the data asks for."""
    n = num_partitions or range_count(df)
    return df.repartitionByRange(n, *by) if n else df.repartitionByRange(*by)


def prefix_offsets(stats: DataFrame, order: list[str], count: str, stage_path: str,
                   ranges: int | None = None) -> DataFrame:
    """Exclusive running totals of ``count`` in ``order`` order, in Spark.

    Two levels, so neither the driver nor one task sees every group: the
    groups are range-split into slices (staged, so the slicing is fixed),
    running totals are taken inside each slice by a window partitioned by
    slice, and only the slice totals (one row a shuffle partition at most)
    reach the driver."""
    spark = stats.sparkSession
    sliced = by_ranges(stats, order, ranges)
    sliced.withColumn("_rp", F.spark_partition_id()).write.mode("overwrite").parquet(stage_path)
    sliced = spark.read.parquet(stage_path)
    totals = sorted((r["_rp"], r["_t"]) for r in
                    sliced.groupBy("_rp").agg(F.sum(count).alias("_t")).collect())
    base, run = [], 0
    for rp, t in totals:
        base.append((rp, run))
        run += t
    bases = F.broadcast(spark.createDataFrame(base, "_rp int, _base long"))
    within = Window.partitionBy("_rp").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (sliced.join(bases, "_rp")
            .withColumn("_off", F.col("_base") + F.coalesce(F.sum(count).over(within), F.lit(0)))
            .drop("_rp", "_base"))


def natural_order(path: Column) -> Column:
    """Sort key of a path in which runs of digits compare as numbers, so that
    ``part-100000`` follows ``part-99999``."""
    padded = F.regexp_replace(path, r"(\d+)", "0000000000$1")
    return F.regexp_replace(padded, r"0{0,10}(\d{10,})", "$1")


def _number(staged: DataFrame, order: list[str], id_col: str, stage_path: str) -> DataFrame:
    spark = staged.sparkSession
    stats = staged.groupBy("_g", *[c for c in order if c != "_g"]).agg(
        F.min("_m").alias("_m0"), F.max("_m").alias("_m1"), F.count(F.lit(1)).alias("_n"))
    stats.write.mode("overwrite").parquet(f"{stage_path}_groups")
    stats = spark.read.parquet(f"{stage_path}_groups")
    seen = stats.agg(F.count(F.lit(1)).alias("groups"), F.count_distinct("_g").alias("keys"),
                     F.count_if(F.col("_m1") - F.col("_m0") + 1 != F.col("_n")).alias("gaps")).first()
    if seen["gaps"]:
        raise ValueError("rows were removed after their positions were taken; stage the kept rows first")
    if seen["keys"] < seen["groups"]:
        raise RuntimeError("two file splits share one group key")
    if order != ["_g"]:
        stats = stats.withColumn("_name", natural_order(F.col(order[0])))
        order = ["_name", *order]
    shifts = prefix_offsets(stats, order, "_n", f"{stage_path}_offsets").select(
        "_g", (F.col("_off") - F.col("_m0") + 1).alias("_shift"))
    if seen["groups"] <= BROADCAST_GROUPS_MAX:
        shifts = F.broadcast(shifts)
    kept = [c for c in staged.columns if c not in ("_g", "_m", *order)]
    return staged.join(shifts, "_g").select((F.col("_m") + F.col("_shift")).alias(id_col), *kept)


def surrogate_ids(df: DataFrame, stage_path: str, *, order_by: Sequence[str] | None = None,
                  position: Sequence[str] = ("_src_file", "_src_block", "_src_row"),
                  id_col: str = "id", num_partitions: int | None = None) -> DataFrame:
    """``df`` with a leading ``id`` column numbered 1..n.

    ``order_by``: number in key order.  Otherwise ``position`` names the
    (file, split start, row) columns of ``sources.csvfiles`` and rows are
    numbered in input order; those columns are dropped from the result.  A
    column that is already called ``id_col``, or rows missing from inside a
    split, raise an error."""
    if id_col.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the data already has a column {id_col!r}")
    spark = df.sparkSession
    if order_by:
        keyed = df.withColumn("_tb", F.monotonically_increasing_id())
        by = [*order_by, "_tb"]
        ranged = by_ranges(keyed, by, num_partitions)
        tagged = (ranged.sortWithinPartitions(*by).withColumn("_g", F.spark_partition_id().cast("long"))
                  .withColumn("_m", F.monotonically_increasing_id()).drop("_tb"))
        order = ["_g"]
    else:
        f, b, r = position
        tagged = df.withColumnRenamed(r, "_m").withColumn("_g", F.xxhash64(f, b))
        order = [f, b]
    tagged.write.mode("overwrite").parquet(stage_path)
    return _number(spark.read.parquet(stage_path), order, id_col, stage_path)
