"""Message-topic sources.

A topic is read either from Kafka (``format("kafka")``, when the connector jar
is on the classpath) or from a *wire table*: parquet files with the Kafka
source's columns (``key value topic partition offset timestamp
timestampType``).  Both give the same DataFrame, batch or streaming, so every
downstream operator is source-agnostic.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import FAIL_ON_DATA_LOSS, STARTING_OFFSETS
from ..schemas import WIRE_SCHEMA
from ..session import path_exists, touch

#: File in a checkpoint folder that holds the start of a ``latest`` stream over a wire table.
START_BOUND = "start_bound.json"


def format_available(spark: SparkSession, fmt: str) -> bool:
    """True when a data source short name resolves on this cluster."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark._jsparkSession.sessionState().conf()
        jvm.org.apache.spark.sql.execution.datasources.DataSource.lookupDataSource(fmt, conf)
        return True
    except Exception:
        return False


def _require_kafka(spark: SparkSession) -> None:
    if not format_available(spark, "kafka"):
        raise RuntimeError("the Kafka source is not on the classpath (spark-sql-kafka package); "
                           "read a wire table with TopicSource(wire_path=...) instead")


@dataclass
class TopicSource:
    """Where messages come from and which of them to read.

    ``topics`` (subscribe) or ``pattern`` (subscribePattern) select topics;
    ``bootstrap`` selects Kafka, ``wire_path`` a wire table."""

    topics: tuple[str, ...] = ()
    pattern: str | None = None
    bootstrap: str | None = None
    wire_path: str | None = None
    starting_offsets: str = STARTING_OFFSETS
    fail_on_data_loss: str = FAIL_ON_DATA_LOSS
    max_per_trigger: int | None = None
    options: dict = field(default_factory=dict)

    def _kafka_options(self) -> dict:
        opts = {"kafka.bootstrap.servers": self.bootstrap,
                "startingOffsets": self.starting_offsets,
                "failOnDataLoss": self.fail_on_data_loss}
        if self.pattern:
            opts["subscribePattern"] = self.pattern
        else:
            opts["subscribe"] = ",".join(self.topics)
        if self.max_per_trigger:
            opts["maxOffsetsPerTrigger"] = str(self.max_per_trigger)
        opts.update(self.options)
        return opts

    def _select_topics(self, df: DataFrame) -> DataFrame:
        if self.pattern:
            return df.where(F.col("topic").rlike(f"^(?:{self.pattern})$"))
        if self.topics:
            return df.where(F.col("topic").isin(list(self.topics)))
        return df

    def read_stream(self, spark: SparkSession, checkpoint: str | None = None) -> DataFrame:
        """Unbounded DataFrame of wire rows.  A wire table is a file stream: from
        ``earliest``, files already present are read first; from ``latest``,
        only files that land after the first start, which ``checkpoint`` (the
        query's checkpoint folder) remembers over restarts.

        ``fail_on_data_loss="false"`` lets a run go on without files that were
        deleted before they were read; :func:`lost_files` names them."""
        if self.bootstrap:
            _require_kafka(spark)
            return spark.readStream.format("kafka").options(**self._kafka_options()).load()
        if self.starting_offsets not in ("earliest", "latest"):
            raise ValueError("a wire table is streamed from 'earliest' or 'latest'")
        reader = spark.readStream.schema(WIRE_SCHEMA)
        if self.max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", self.max_per_trigger)
        if str(self.fail_on_data_loss).lower() == "false":
            reader = reader.option("ignoreMissingFiles", "true")
        rows = reader.parquet(self.wire_path)
        if self.starting_offsets == "latest":
            if not checkpoint:
                raise ValueError("a wire table is streamed from 'latest' with a checkpoint folder, which keeps the start")
            rows = rows.where(_landed_after(start_bound(spark, self.wire_path, checkpoint)))
        return self._select_topics(rows)

    def read(self, spark: SparkSession, ending_offsets: str = "latest") -> DataFrame:
        """Bounded read between ``starting_offsets`` and ``ending_offsets``
        (``earliest``/``latest`` or Spark's JSON offset map)."""
        if self.bootstrap:
            _require_kafka(spark)
            opts = self._kafka_options()
            if opts["startingOffsets"] == "latest":
                raise ValueError("a bounded read starts at 'earliest' or at an offset map")
            opts["endingOffsets"] = ending_offsets
            opts.pop("maxOffsetsPerTrigger", None)
            return spark.read.format("kafka").options(**opts).load()
        df = self._select_topics(spark.read.schema(WIRE_SCHEMA).parquet(self.wire_path))
        from ..operators.offsets import offset_range
        return offset_range(df, self.starting_offsets, ending_offsets)


def start_bound(spark: SparkSession, wire_path: str, checkpoint: str) -> dict:
    """Where a ``latest`` start of a wire table begins: the time of the newest file
    that was there at the first start, and the names of the files of that very
    time.  Kept in the checkpoint folder, so a restart goes on where the first
    start began.  Spark lists the files; one row comes to the driver beside the
    names of one millisecond."""
    kept = f"{checkpoint.rstrip('/')}/{START_BOUND}"
    if path_exists(spark, kept):
        return json.loads(spark.read.option("wholetext", "true").text(kept).first()[0])
    bound = {"time": 0, "names": []}
    if path_exists(spark, wire_path):
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true") \
            .load(wire_path).select("path", F.unix_millis("modificationTime").alias("t"))
        newest = files.agg(F.max("t")).first()[0]
        if newest is not None:
            names = files.where(F.col("t") == newest).select(F.element_at(F.split("path", "/"), -1).alias("n"))
            bound = {"time": newest, "names": sorted(r["n"] for r in names.collect())}
    touch(spark, kept, json.dumps(bound).encode())
    return bound


def _landed_after(bound: dict):
    at = F.unix_millis(F.col("_metadata.file_modification_time"))
    return (at > bound["time"]) | ((at == bound["time"]) & ~F.col("_metadata.file_name").isin(bound["names"]))


def lost_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``path, batch_id`` of the files that a file stream's checkpoint has recorded
    and that are gone: input that was deleted before or after it was read."""
    log = f"{checkpoint.rstrip('/')}/sources/0"
    if not path_exists(spark, log):
        return spark.createDataFrame([], "path string, batch_id long")
    def plain(c):                                      # file:///x and file:/x are one path
        return F.regexp_replace(c, r"^([A-Za-z0-9]+):/+", "$1:/")
    seen = (spark.read.text(log).where(F.col("value").startswith("{"))
            .select(F.from_json("value", "path string, timestamp long, batchId long").alias("e"))
            .select(plain("e.path").alias("path"), F.col("e.batchId").alias("batch_id")).distinct())
    folders = seen.select(F.regexp_replace("path", r"/[^/]*$", "").alias("d")).distinct()
    # one row a folder comes to the driver, and those that are there are listed by Spark
    there = [r["d"] for r in folders.collect() if path_exists(spark, r["d"])]
    if not there:
        return seen
    listed = spark.read.format("binaryFile").load(there).select(plain("_metadata.file_path").alias("path"))
    return seen.join(listed, "path", "left_anti")


def parse_offset_spec(spec: str) -> list[tuple[str, int, int]]:
    """Spark's JSON offset map ``{"topic": {"0": 23, "1": -2}}`` -> rows
    (topic, partition, offset); -2 means earliest, -1 latest."""
    parsed = json.loads(spec)
    return [(t, int(p), int(o)) for t, parts in parsed.items() for p, o in parts.items()]
