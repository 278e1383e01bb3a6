"""Topic offsets: range scans, end offsets per partition, consumer lag.

Offset maps (start/end/committed) are configuration with one row per listed
topic-partition; they are joined as broadcast tables only below a size
bound, else Spark picks the join.  End offsets come from a partial
aggregate over three columns of the wire table, so the shuffle carries one
row per topic-partition and map task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import WIRE_SCHEMA

BROADCAST_MAX_ROWS = 100_000
EARLIEST, LATEST = -2, -1

_MAP_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("bound", T.LongType(), False),
])


def offset_map(spark: SparkSession, spec, name: str = "bound") -> DataFrame:
    """JSON offset map (or rows of (topic, partition, offset)) -> small
    DataFrame ``topic, partition, <name>``."""
    from ..sources.topic import parse_offset_spec
    rows = parse_offset_spec(spec) if isinstance(spec, str) else list(spec)
    df = spark.createDataFrame(rows, _MAP_SCHEMA).withColumnRenamed("bound", name)
    return F.broadcast(df) if len(rows) <= BROADCAST_MAX_ROWS else df


def end_offsets(wire: DataFrame) -> DataFrame:
    """Per topic-partition: first offset, end offset (last + 1), messages."""
    return (wire.groupBy("topic", "partition")
            .agg(F.min("offset").alias("start_offset"),
                 (F.max("offset") + 1).alias("end_offset"),
                 F.count(F.lit(1)).alias("messages")))


def footer_offsets(spark: SparkSession, path: str) -> DataFrame:
    """:func:`end_offsets` of a wire table laid out by topic and partition
    (``write_by_partition``), from the statistics in its parquet footers: the
    aggregate is pushed into the scan and no row is read.  A sister session
    holds the two settings this needs, the caller's stay as they are."""
    reader = spark.newSession()
    reader.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    reader.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    wire = reader.read.schema(WIRE_SCHEMA).parquet(path)
    # without an alias inside: only bare MIN, MAX and COUNT are pushed
    return (wire.groupBy("topic", "partition").agg(F.min("offset"), F.max("offset"), F.count(F.lit(1)))
            .toDF("topic", "partition", "start_offset", "last", "messages")
            .select("topic", "partition", "start_offset", (F.col("last") + 1).alias("end_offset"), "messages"))


def write_by_partition(wire: DataFrame, path: str) -> None:
    """Wire rows laid out by topic and partition, in offset order within files."""
    (wire.sortWithinPartitions("topic", "partition", "offset").write.mode("append")
     .partitionBy("topic", "partition").parquet(path))


def topic_offsets(wire: DataFrame, ends: DataFrame | None = None) -> DataFrame:
    """End offsets (``ends`` if they are known) plus, per topic, the partition
    count and whether it holds any message.  The window runs over the aggregate
    (one row per topic-partition), never over messages."""
    per_topic = Window.partitionBy("topic")
    return ((end_offsets(wire) if ends is None else ends)
            .withColumn("partitions", F.count(F.lit(1)).over(per_topic))
            .withColumn("has_messages", F.max(F.col("end_offset") > 0).over(per_topic)))


def offset_range(wire: DataFrame, starting="earliest", ending="latest",
                 default_start: str = "earliest") -> DataFrame:
    """Rows with start <= offset < end per topic-partition.

    ``starting``: ``earliest``, ``latest`` or a JSON map (-2 earliest, -1
    latest); partitions the map omits start at ``default_start``.
    ``ending``: ``latest`` or a JSON map (-1 latest); omitted -> latest."""
    from ..sources.topic import parse_offset_spec
    spark = wire.sparkSession
    out = wire
    start_rows = parse_offset_spec(starting) if starting not in ("earliest", "latest") else []
    need_end = (starting == "latest" or default_start == "latest"
                or any(o == LATEST for _, _, o in start_rows))
    if need_end:
        ends = end_offsets(wire).select("topic", "partition", F.col("end_offset").alias("_end"))
        head = ends.limit(BROADCAST_MAX_ROWS + 1).collect()          # one row per topic-partition
        if len(head) <= BROADCAST_MAX_ROWS:
            ends = offset_map(spark, [tuple(r) for r in head], "_end")
        out = out.join(ends, ["topic", "partition"], "left")
    if starting == "latest":
        out = out.where(F.col("offset") >= F.col("_end"))
    elif starting != "earliest":
        starts = offset_map(spark, start_rows, "_start")
        out = out.join(starts, ["topic", "partition"], "left")
        dflt = F.col("_end") if default_start == "latest" else F.lit(None)
        lo = (F.when(F.col("_start") == EARLIEST, F.lit(None))
              .when(F.col("_start") == LATEST, F.col("_end") if need_end else F.lit(None))
              .when(F.col("_start").isNull(), dflt)
              .otherwise(F.col("_start")))
        out = out.where(lo.isNull() | (F.col("offset") >= lo))
    if ending != "latest":
        stops = offset_map(spark, ending, "_stop")
        out = out.join(stops, ["topic", "partition"], "left")
        out = out.where(F.col("_stop").isNull() | (F.col("_stop") == LATEST)
                        | (F.col("offset") < F.col("_stop")))
    return out.select(*wire.columns)


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """``topic, partition, committed_offset`` of a consumer that wrote the next
    offset to read of every batch below ``path`` (``streaming.jobs.write_commits``)."""
    commits = spark.read.schema("topic string, partition int, committed_offset long").parquet(f"{path}/batch_id=*")
    return commits.groupBy("topic", "partition").agg(F.max("committed_offset").alias("committed_offset"))


def consumer_lag(wire: DataFrame, committed, ends: DataFrame | None = None) -> DataFrame:
    """End offsets left-joined with a consumer group's committed offsets
    (next offset to read): a DataFrame as :func:`read_commits` gives it, or an
    offset map.  ``ends`` are the topic's end offsets if they are known.  Lag = end - committed; a partition without a commit lags by all
    its messages (end - start), committed shown NULL."""
    ends = end_offsets(wire) if ends is None else ends
    spark = ends.sparkSession
    com = committed if isinstance(committed, DataFrame) else offset_map(spark, committed, "committed_offset")
    return (ends.join(com, ["topic", "partition"], "left")
            .select("topic", "partition", "end_offset", "committed_offset",
                    (F.col("end_offset") - F.coalesce(F.col("committed_offset"), F.col("start_offset")))
                    .alias("lag")))
