"""Streaming queries: the change job under readStream/writeStream, restart
with exactly-once output, and reading the lake table as of a batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import CAPTURE_TOPIC
from ..operators.flatten import flatten_changes
from ..schemas import FLAT_COLUMNS
from ..sources.topic import TopicSource
from ..streaming.jobs import (append_batches_tagged, append_stream, read_as_of,
                              run_available, start_change_stream)
from .changes import FLAT_ORACLE
from .fixtures import capture_wire, load
from .registry import register
from .staging import fresh, staged
from .sqlparts import EVENTS_CTE, TS_TEXT


def _capture_source(spark, sf_dir, **kw) -> TopicSource:
    path = staged(spark, sf_dir, "capture_wire", lambda: capture_wire(load(spark, sf_dir, "events")))
    return TopicSource(topics=(CAPTURE_TOPIC,), wire_path=path, starting_offsets="earliest", **kw)


@register("stream_cdc_flatten", FLAT_ORACLE)
def stream_cdc_flatten(spark, sf_dir):
    """The flattening job as a stream over the capture topic, appended to a
    parquet lake table and read back."""
    src = _capture_source(spark, sf_dir)
    out = fresh(spark, "stream_cdc_flatten")
    flat = flatten_changes(src.read_stream(spark), processed_at=False)
    run_available(append_stream(flat, out, fmt="parquet", trigger="availableNow"))
    return spark.read.parquet(out)


@register("stream_append", FLAT_ORACLE)
def stream_append(spark, sf_dir):
    """The job as configured for production (checkpoint inside the table
    folder, append mode, processing-time column), run with availableNow."""
    src = _capture_source(spark, sf_dir)
    out = fresh(spark, "stream_append")
    run_available(start_change_stream(spark, src, out, fmt="parquet", trigger="availableNow"))
    table = spark.read.parquet(out)
    return table.where(F.col("processed_at").isNotNull()).select(*FLAT_COLUMNS)


def _run_in_three_drops(spark, sf_dir, name, start):
    """Write the capture topic in three drops (partition 0, 1, 2), running the
    stream after each and once more with nothing new; returns the sink."""
    wire = capture_wire(load(spark, sf_dir, "events"))
    root, out = fresh(spark, name + "_wire"), fresh(spark, name)
    src = TopicSource(topics=(CAPTURE_TOPIC,), wire_path=root, starting_offsets="earliest")
    for p in (0, 1, 2, None):
        if p is not None:
            wire.where(F.col("partition") == p).write.mode("append").parquet(root)
        run_available(start(src.read_stream(spark), out))
    return out


@register("stream_restart", FLAT_ORACLE)
def stream_restart(spark, sf_dir):
    """Four runs on one checkpoint while data arrives in three drops: every
    message lands exactly once."""
    def start(stream, out):
        return append_stream(flatten_changes(stream, processed_at=False), out,
                             fmt="parquet", trigger="availableNow")
    return spark.read.parquet(_run_in_three_drops(spark, sf_dir, "stream_restart", start))


@register("stream_latest", f"{FLAT_ORACLE.rstrip()} WHERE part > 0")
def stream_latest(spark, sf_dir):
    """The job started at ``latest`` as configured: what was on the topic before is
    not read; what lands between and after its runs is, once."""
    wire = capture_wire(load(spark, sf_dir, "events"))
    root, out = fresh(spark, "stream_latest_wire"), fresh(spark, "stream_latest")
    src = TopicSource(topics=(CAPTURE_TOPIC,), wire_path=root, starting_offsets="latest")
    for p in (0, None, 1, 2, None):
        if p is not None:
            wire.where(F.col("partition") == p).write.mode("append").parquet(root)
        if p != 1:                                      # partitions 1 and 2 land between two runs
            run_available(start_change_stream(spark, src, out, fmt="parquet", trigger="availableNow"))
    return spark.read.parquet(out).select(*FLAT_COLUMNS)


ASOF_ORACLE = f"""
WITH {EVENTS_CTE}
SELECT CASE WHEN NOT bad THEN i END AS id,
       CASE WHEN NOT bad THEN op_code END AS op,
       CASE WHEN NOT bad THEN {TS_TEXT.format('ts')} END AS created_at_ts,
       CASE WHEN NOT bad THEN {TS_TEXT.format("ts + to_microseconds(updated_us - created_us)")} END AS updated_at_ts,
       CASE WHEN NOT bad AND i % 7 <> 0 THEN value END AS booking_value,
       CASE WHEN NOT bad AND i % 11 <> 0 THEN CAST(user_id AS DOUBLE) / 10 END AS ride_distance,
       part AS batch_id
FROM ev WHERE part <= 1
"""


@register("asof_batch", ASOF_ORACLE)
def asof_batch(spark, sf_dir):
    """Lake table as of batch 1: micro-batches are tagged with their batch id
    (idempotent per batch), and a reader selects batches 0..v."""
    def start(stream, out):
        return append_batches_tagged(flatten_changes(stream, processed_at=False), out)
    out = _run_in_three_drops(spark, sf_dir, "asof_batch", start)
    df = read_as_of(spark, out, 1)
    return df.select(*FLAT_COLUMNS, F.col("batch_id").cast("int").alias("batch_id"))
