"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(docs: DataFrame, text_col: str = "text") -> Column:
    """The text column; null counts as the empty text."""
    return F.coalesce(docs[text_col].cast("string"), F.lit(""))


def unused_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` is called so (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def crc_fold(id_col: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null id: null)."""
    return F.crc32(id_col.cast("string").cast("binary")) % modulus


#: Rows of a caller's lookup table up to which it is broadcast.
BROADCAST_ROWS = 100_000


def lookup(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``table`` marked for broadcast where it has at most ``rows`` rows; beyond
    that Spark picks the join."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def sample_bound(size: int, n: int) -> int:
    """Bound on a 63-bit hash under which ``size`` of ``n`` rows are expected."""
    return min(size * (1 << 63) // max(n, 1), (1 << 63) - 1)


def sampled(rows: DataFrame, id_col: str, size: int, n: int) -> DataFrame:
    """All of ``n`` rows, or of more than ``size`` about that many by a hash of the id."""
    if n <= size:
        return rows
    return rows.where(F.shiftrightunsigned(F.xxhash64(id_col), 1) < F.lit(sample_bound(size, n)))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back, which
    cuts the lineage at files that every executor can see."""
    path = fresh_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, name: str = "components",
                         max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``: the smallest
    node reachable.  Alternating large-star and small-star steps; each round
    is written to the shared folder, and only a row count and a hash sum come
    to the driver.  An empty edge table gives an empty result."""
    def links(u, v):
        return F.when(u > v, F.struct(u.alias("u"), v.alias("v"))).otherwise(
            F.struct(v.alias("u"), u.alias("v")))

    def mark(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = (edges.where("a <> b").select(links(F.col("a"), F.col("b")).alias("e"))
         .select("e.u", "e.v").distinct())
    e = materialize(e, f"{name}-0")
    seen = mark(e)
    for k in range(1, max_rounds + 1):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(
                     F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                     F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        e = materialize(small, f"{name}-{k}")
        now = mark(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"{name}: no fixpoint after {max_rounds} rounds")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())


