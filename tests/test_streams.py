"""Runs of the file-topic streams: trigger and normal end, a start at latest over
restarts, input that is deleted."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from tideline.sources.topic import TopicSource, lost_files
from tideline.streaming.jobs import append_stream, run_available, run_until_idle, start_change_stream


def _wire(spark, lo, hi):
    return spark.range(lo, hi).select(
        F.lit(None).cast("binary").alias("key"), F.to_json(F.struct("id")).cast("binary").alias("value"),
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType")).coalesce(1)


def _ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).select("id").collect())


def test_a_processing_time_run_ends_when_nothing_comes(spark, tmp_path):
    root, out = str(tmp_path / "wire"), str(tmp_path / "out")
    _wire(spark, 0, 5).write.mode("append").parquet(root)
    q = start_change_stream(spark, TopicSource(wire_path=root, starting_offsets="earliest"), out, fmt="parquet",
                            trigger="1 second")
    while not [p for p in q.recentProgress if p.numInputRows]:
        time.sleep(0.1)
    _wire(spark, 5, 9).write.mode("append").parquet(root)
    run_until_idle(q, idle_s=4, timeout_s=60)
    assert not q.isActive and q.exception() is None
    assert len([p for p in q.recentProgress if p.numInputRows]) >= 2
    assert _ids(spark, out) == list(range(9))


def test_latest_is_kept_over_restarts(spark, tmp_path):
    root, out = str(tmp_path / "wire"), str(tmp_path / "out")
    src = TopicSource(wire_path=root, starting_offsets="latest")

    def run():
        run_available(start_change_stream(spark, src, out, fmt="parquet", trigger="availableNow"))
    _wire(spark, 0, 5).write.mode("append").parquet(root)
    run()
    assert _ids(spark, out) == []
    _wire(spark, 5, 8).write.mode("append").parquet(root)
    for f in glob.glob(root + "/*.parquet"):            # all files of one time: names decide
        os.utime(f, (os.path.getmtime(min(glob.glob(root + "/*.parquet"), key=os.path.getmtime)),) * 2)
    run()
    _wire(spark, 8, 12).write.mode("append").parquet(root)
    run()
    run()
    assert _ids(spark, out) == list(range(5, 12))
    with pytest.raises(ValueError, match="checkpoint"):
        src.read_stream(spark)


def test_deleted_input_does_not_stop_a_run_and_is_named(spark, tmp_path):
    root, out = str(tmp_path / "wire"), str(tmp_path / "out")
    src = TopicSource(wire_path=root, starting_offsets="earliest", max_per_trigger=1)
    _wire(spark, 0, 5).write.mode("append").parquet(root)
    run_available(append_stream(src.read_stream(spark), out, trigger="availableNow"))
    ck = f"{out}/_checkpoints"
    assert lost_files(spark, ck).count() == 0
    gone = glob.glob(root + "/*.parquet")
    for f in gone:
        os.unlink(f)
    _wire(spark, 5, 7).write.mode("append").parquet(root)
    run_available(append_stream(src.read_stream(spark), out, trigger="availableNow"))
    assert spark.read.parquet(out).count() == 7
    assert [r.path.rsplit("/", 1)[1] for r in lost_files(spark, ck).collect()] == [os.path.basename(f) for f in gone]
