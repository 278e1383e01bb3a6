"""Capture semantics on hand-made envelopes; offsets and lag."""

import json

from pyspark.sql import functions as F

from tideline.operators.capture import (capture_to_topic, outcome_counts, parse_envelopes, rejected_envelopes,
                                        unwrap_envelopes)
from tideline.operators.offsets import consumer_lag, offset_range, topic_offsets
from tideline.sources.topic import TopicSource
from tideline.streaming.jobs import run_available, start_capture_stream


def _env(op, schema="public", table="business_t", rid=1):
    row = {"id": rid, "created_at": 5, "updated_at": 6}
    env = {"before": row if op == "d" else None, "after": None if op == "d" else row,
           "source": {"db": "d", "schema": schema, "table": table, "ts_ms": 1}, "op": op, "ts_ms": 9}
    return json.dumps(env).encode()


def _wire(spark, values):
    rows = [(b"k", v, "raw", 0, i, None, 0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, "
                                       "offset long, timestamp timestamp, timestampType int")


def test_unwrap_drops_snapshot_and_turns_deletes_into_tombstones(spark):
    wire = _wire(spark, [_env("c"), _env("u"), _env("d"), _env("r")])
    out = capture_to_topic(wire).orderBy("offset").collect()
    assert [r.offset for r in out] == [0, 1, 2]
    assert out[2].value is None
    rec = json.loads(out[0].value)
    assert rec["__op"] == "c" and rec["__ts_ms"] == 9 and rec["id"] == 1
    assert out[0].topic == "business_postgres.public.business_t"


def test_include_list_is_a_whole_name_regex(spark):
    wire = _wire(spark, [_env("c", "public", "business_x"), _env("c", "staging", "business_x"),
                         _env("c", "public", "xbusiness_x"), _env("c", "publicAbusiness_x"[:6], "business_y")])
    kept = parse_envelopes(wire).select("offset").collect()
    assert sorted(r.offset for r in kept) == [0, 3]


def test_unwrap_can_drop_tombstones(spark):
    env = parse_envelopes(_wire(spark, [_env("c"), _env("d")]))
    assert unwrap_envelopes(env, drop_tombstones=True).count() == 1


def _offsets_wire(spark):
    rows = [(None, b"{}", t, p, o, None, 0) for t in ("a", "b") for p in (0, 1) for o in range(10)]
    return spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, "
                                       "offset long, timestamp timestamp, timestampType int")


def test_offset_range_and_lag(spark):
    w = _offsets_wire(spark)
    spec = json.dumps({"a": {"0": 4, "1": -1}})
    got = offset_range(w, spec, json.dumps({"b": {"1": 3}}))
    counts = {(r.topic, r.partition): r["count"] for r in got.groupBy("topic", "partition").count().collect()}
    assert counts == {("a", 0): 6, ("b", 0): 10, ("b", 1): 3}
    lag = {(r.topic, r.partition): r.lag for r in consumer_lag(w, json.dumps({"a": {"0": 7}})).collect()}
    assert lag[("a", 0)] == 3 and lag[("b", 1)] == 10
    offs = topic_offsets(w).where(F.col("topic") == "a").collect()
    assert {r.end_offset for r in offs} == {10} and {r.partitions for r in offs} == {2}


def _messy(spark):
    raw = [_env("c"), _env("d"), _env("r"), b"{bad", None, b"null", b"[1]", b'{"a":1}', _env("c", "staging"), _env("x"),
           _env("c").replace(b'"op": "c"', b'"op": null'), _env("c")[:-9],
           json.dumps({"after": None, "op": "c", "ts_ms": 1, "source": {"schema": "public", "table": "business_t"}}).encode(),
           json.dumps({"after": "text", "op": "u", "ts_ms": 1, "source": {"schema": "public", "table": "business_t"}}).encode(),
           json.dumps({"after": {}, "op": "u", "ts_ms": 1, "source": {"schema": "public", "table": "business_t"}}).encode()]
    return _wire(spark, raw), len(raw)


def test_every_message_has_one_outcome(spark):
    wire, n = _messy(spark)
    counts = {r.outcome: r.messages for r in outcome_counts(wire).collect()}
    assert sum(counts.values()) == n
    assert counts == {"change": 2, "delete": 1, "snapshot": 1, "not included": 1, "no value": 1, "not an envelope": 5,
                      "unknown operation": 1, "no operation": 1, "no row state": 2}
    assert rejected_envelopes(wire).count() == 10
    values = [r.value and json.loads(r.value) for r in capture_to_topic(wire).orderBy("offset").collect()]
    assert values == [{"id": 1, "created_at": 5, "updated_at": 6, "__op": "c", "__ts_ms": 9}, None, {"__op": "u", "__ts_ms": 1}]


def test_capture_stream_replays_a_batch_without_doubling(spark, tmp_path):
    wire, n = _messy(spark)
    src = str(tmp_path / "wire")
    wire.write.parquet(src)
    source = TopicSource(topics=("raw",), wire_path=src, starting_offsets="earliest")
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    for k in range(2):                     # a second run from an empty checkpoint delivers batch 0 again
        run_available(start_capture_stream(spark, source, good, bad, checkpoint=str(tmp_path / f"ck{k}"), trigger="availableNow"))
        assert spark.read.parquet(good).count() == 3 and spark.read.parquet(bad).count() == 10
