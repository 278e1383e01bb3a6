"""The streaming change job: topic -> flatten -> append to a lake table.

One stateless projection per micro-batch (no shuffle, no state store);
exactly-once through the sink's checkpoint, kept inside the table folder
(``<table>/_checkpoints``; the ``_`` prefix hides it from readers)."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..constants import CHECKPOINT_SUBDIR, TRIGGER_INTERVAL
from ..operators.flatten import flatten_changes
from ..sources.topic import TopicSource, format_available


def lake_format(spark: SparkSession, preferred: str = "delta") -> str:
    """Delta when its jar is present, else parquet (the file sink is also
    exactly-once through its ``_spark_metadata`` log)."""
    return preferred if format_available(spark, preferred) else "parquet"


def _trigger(writer, trigger):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def append_stream(df: DataFrame, table_path: str, *, fmt: str = "parquet",
                  checkpoint: str | None = None, trigger: str = TRIGGER_INTERVAL,
                  query_name: str | None = None) -> StreamingQuery:
    """Append a streaming DataFrame to a lake table with a checkpoint."""
    writer = (df.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint or f"{table_path}/{CHECKPOINT_SUBDIR}")
              .option("path", table_path))
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger).start()


def start_change_stream(spark: SparkSession, source: TopicSource, table_path: str, *,
                        fmt: str | None = None, trigger: str = TRIGGER_INTERVAL,
                        checkpoint: str | None = None, typed_time: bool = False) -> StreamingQuery:
    """The streaming job: read the topic, flatten each message, append."""
    checkpoint = checkpoint or f"{table_path}/{CHECKPOINT_SUBDIR}"
    flat = flatten_changes(source.read_stream(spark, checkpoint), typed_time=typed_time)
    return append_stream(flat, table_path, fmt=fmt or lake_format(spark),
                         checkpoint=checkpoint, trigger=trigger)


def run_available(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait until the stream ends, or stop it after ``timeout_s`` seconds (its
    checkpoint keeps what it has done); surface its failure."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def run_until_idle(query: StreamingQuery, idle_s: float, timeout_s: float) -> StreamingQuery:
    """Let a processing-time query run until no message has come for ``idle_s``
    seconds or ``timeout_s`` have passed, and stop it; its own progress reports
    say whether messages came.  The query ends normally: a batch under way is
    finished first, and its failure is raised."""
    start = last = time.monotonic()
    seen = None
    while query.isActive and time.monotonic() - start < timeout_s and time.monotonic() - last < idle_s:
        query.awaitTermination(0.2)
        for p in query.recentProgress:
            if (seen is None or p.batchId > seen) and p.numInputRows:
                seen, last = p.batchId, time.monotonic()
        if query.isActive and query.status["isTriggerActive"] and query.status["isDataAvailable"]:
            last = time.monotonic()
    if query.isActive:
        deadline = time.monotonic() + timeout_s
        while query.isActive and query.status["isTriggerActive"] and time.monotonic() < deadline:
            query.awaitTermination(0.05)
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def append_batches_tagged(df: DataFrame, table_path: str, *, checkpoint: str | None = None,
                          trigger: str = "availableNow") -> StreamingQuery:
    """Append each micro-batch under ``batch_id=<n>`` so that a reader can ask
    for the table as of batch n.  Writing a batch overwrites its own folder,
    so a batch replayed after a failure is idempotent."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}")

    writer = (df.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint or f"{table_path}/{CHECKPOINT_SUBDIR}"))
    return _trigger(writer, trigger).start()


def read_as_of(spark: SparkSession, table_path: str, version: int) -> DataFrame:
    """Rows appended by batches 0..version (partition pruning on batch_id)."""
    df = spark.read.option("basePath", table_path).parquet(f"{table_path}/batch_id=*")
    return df.where(F.col("batch_id") <= version)


def start_capture_stream(spark: SparkSession, source: TopicSource, changes_path: str, rejected_path: str, *,
                         checkpoint: str | None = None, trigger: str = TRIGGER_INTERVAL) -> StreamingQuery:
    """The capture hop as a stream with two sinks: each micro-batch is parsed
    once and kept, its changes (flat wire rows) go to ``changes_path`` and the
    envelopes without a usable change, with their reason, to ``rejected_path``.
    Both are folders ``batch_id=<n>`` that a replayed batch overwrites, so a
    batch that failed between its two writes leaves no row twice."""
    from pyspark import StorageLevel
    from ..operators.capture import CHANGE, DELETE, REJECTED, captured_rows

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = captured_rows(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            (rows.where(F.col("outcome").isin(CHANGE, DELETE)).drop("outcome")
             .write.mode("overwrite").parquet(f"{changes_path}/batch_id={batch_id}"))
            (rows.where(F.col("outcome").isin(*REJECTED))
             .select("topic", "partition", "offset", "timestamp", "value", F.col("outcome").alias("reason"))
             .write.mode("overwrite").parquet(f"{rejected_path}/batch_id={batch_id}"))
        finally:
            rows.unpersist()

    writer = (source.read_stream(spark).writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint or f"{changes_path}/{CHECKPOINT_SUBDIR}"))
    return _trigger(writer, trigger).start()


def write_commits(batch: DataFrame, commits_path: str, batch_id: int) -> None:
    """The next offset to read of every topic-partition in a batch, written after
    the batch's own output; a replayed batch overwrites its entry."""
    (batch.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("committed_offset"))
     .write.mode("overwrite").parquet(f"{commits_path}/batch_id={batch_id}"))


def start_committing_stream(spark: SparkSession, source: TopicSource, table_path: str, commits_path: str, *,
                            checkpoint: str | None = None, trigger: str = TRIGGER_INTERVAL) -> StreamingQuery:
    """The change job as a consumer that records how far it has come: each batch
    appends its flat rows (folder ``batch_id=<n>``) and then its offsets, which
    ``operators.offsets.consumer_lag`` compares with the end of the topic."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        flatten_changes(batch).write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}")
        write_commits(batch, commits_path, batch_id)

    writer = (source.read_stream(spark, checkpoint).writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint or f"{table_path}/{CHECKPOINT_SUBDIR}"))
    return _trigger(writer, trigger).start()


def start_validation_stream(spark: SparkSession, source: TopicSource, table_path: str, *,
                            trigger: str = TRIGGER_INTERVAL, checkpoint: str | None = None,
                            fmt: str = "parquet") -> StreamingQuery:
    """The validating consumer as a stream: every message of the subscribed
    topics becomes one (topic, partition, offset, valid, reason) row.
    Stateless; counts are a batch query over the result."""
    from ..operators.validate import validate_messages
    return append_stream(validate_messages(source.read_stream(spark)), table_path, fmt=fmt,
                         checkpoint=checkpoint, trigger=trigger)
