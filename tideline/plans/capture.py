"""Queries for the capture hop: include filter, unwrap, routing, and the
whole chain envelope -> flat topic -> typed rows."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import BOOKING_FIELD, RIDE_FIELD
from ..operators.capture import (capture_to_topic, outcome_counts, parse_envelopes, rejected_envelopes, route_topic,
                                 unwrap_envelopes)
from ..operators.flatten import flatten_changes
from ..schemas import ROW_STATE
from ..session import fresh_path
from ..sources.topic import TopicSource
from ..streaming.jobs import run_available, start_capture_stream
from .fixtures import ENVELOPE_TOPIC, envelope_wire, load, messy_envelope_wire
from .registry import register
from .sqlparts import BOOKING_TEXT, ENV_CTE, EVENTS_CTE, MESSY_CTE, RIDE_TEXT, TS_TEXT
from .staging import staged, staged_wire


def _envelopes(spark, sf_dir):
    return staged_wire(spark, sf_dir, "envelope_wire", lambda: envelope_wire(load(spark, sf_dir, "events")))


@register("capture_filter", f"""
WITH {EVENTS_CTE}, {ENV_CTE}
SELECT part AS partition, off3 AS "offset", env_schema AS "schema", env_table AS "table", env_op AS op FROM cap
""")
def capture_filter(spark, sf_dir):
    """Changes of the tables matching the include list (whole-name regex)."""
    env = parse_envelopes(_envelopes(spark, sf_dir))
    s = F.col("env.source")
    return env.select("partition", "offset", s.getField("schema").alias("schema"),
                      s.getField("table").alias("table"), F.col("env.op").alias("op"))


@register("envelope_unwrap", f"""
WITH {EVENTS_CTE}, {ENV_CTE}
SELECT part AS partition, off3 AS "offset", env_op = 'd' AS is_tombstone,
       CASE WHEN env_op <> 'd' THEN i END AS id,
       CASE WHEN env_op <> 'd' THEN created_us END AS created_at,
       CASE WHEN env_op <> 'd' THEN updated_us END AS updated_at,
       CASE WHEN env_op <> 'd' THEN env_op END AS op,
       CASE WHEN env_op <> 'd' THEN env_ms + 500 END AS ts_ms,
       CASE WHEN env_op <> 'd' THEN {BOOKING_TEXT} END AS booking_text,
       CASE WHEN env_op <> 'd' THEN {RIDE_TEXT} END AS ride_text
FROM cap WHERE env_op <> 'r'
""")
def envelope_unwrap(spark, sf_dir):
    """New row state + __op/__ts_ms; deletes leave a tombstone; no snapshot
    reads."""
    env = unwrap_envelopes(parse_envelopes(_envelopes(spark, sf_dir)))
    schema = T.StructType([*ROW_STATE.fields, T.StructField("__op", T.StringType()),
                           T.StructField("__ts_ms", T.LongType())])
    env = env.select("partition", "offset", "record", F.from_json("record", schema).alias("_r"))
    r = F.col("_r")
    return env.select("partition", "offset", F.col("record").isNull().alias("is_tombstone"),
                      r.getField("id").alias("id"), r.getField("created_at").alias("created_at"),
                      r.getField("updated_at").alias("updated_at"), r.getField("__op").alias("op"),
                      r.getField("__ts_ms").alias("ts_ms"),
                      r.getField(BOOKING_FIELD).alias("booking_text"),
                      r.getField(RIDE_FIELD).alias("ride_text"))


@register("topic_route", f"""
WITH {EVENTS_CTE}, {ENV_CTE}
SELECT part AS partition, off3 AS "offset",
       'business_postgres.' || env_schema || '.' || env_table AS topic
FROM cap WHERE env_op <> 'r'
""")
def topic_route(spark, sf_dir):
    """Each captured change's topic: <prefix>.<schema>.<table>."""
    env = unwrap_envelopes(parse_envelopes(_envelopes(spark, sf_dir)))
    return env.select("partition", "offset", route_topic().alias("topic"))


@register("capture_flatten", f"""
WITH {EVENTS_CTE}, {ENV_CTE}
SELECT 'business_postgres.' || env_schema || '.' || env_table AS topic, part AS partition, off3 AS "offset",
       CASE WHEN env_op <> 'd' THEN i END AS id,
       CASE WHEN env_op <> 'd' THEN env_op END AS op,
       CASE WHEN env_op <> 'd' THEN {TS_TEXT.format('ts')} END AS created_at_ts,
       CASE WHEN env_op <> 'd' THEN {TS_TEXT.format("ts + to_microseconds(updated_us - created_us)")} END AS updated_at_ts,
       CASE WHEN env_op <> 'd' AND i % 7 <> 0 THEN value END AS booking_value,
       CASE WHEN env_op <> 'd' AND i % 11 <> 0 THEN CAST(user_id AS DOUBLE) / 10 END AS ride_distance
FROM cap WHERE env_op <> 'r'
""")
def capture_flatten(spark, sf_dir):
    """Envelopes -> capture hop -> flat topic -> the flattening job."""
    wire = capture_to_topic(_envelopes(spark, sf_dir))
    return flatten_changes(wire, keep=("topic", "partition", "offset"), processed_at=False)


def _messy_path(spark, sf_dir) -> str:
    return staged(spark, sf_dir, "messy_envelope_wire", lambda: messy_envelope_wire(load(spark, sf_dir, "events")))


def _messy(spark, sf_dir):
    return staged_wire(spark, sf_dir, "messy_envelope_wire", lambda: messy_envelope_wire(load(spark, sf_dir, "events")))


_REASONS = "('no value', 'not an envelope', 'no operation', 'unknown operation', 'no row state')"


@register("rejected_envelopes", f"""
WITH {EVENTS_CTE}, {MESSY_CTE}
SELECT '{ENVELOPE_TOPIC}' AS topic, part AS partition, off3 AS "offset", outcome AS reason FROM messy
WHERE outcome IN {_REASONS}
""")
def rejected_envelopes_q(spark, sf_dir):
    """Messages of a raw topic that carry no usable change, with the reason."""
    return rejected_envelopes(_messy(spark, sf_dir))


@register("capture_outcomes", f"""
WITH {EVENTS_CTE}, {MESSY_CTE}
SELECT '{ENVELOPE_TOPIC}' AS topic, outcome, count(*) AS messages FROM messy GROUP BY ALL
""")
def capture_outcomes_q(spark, sf_dir):
    """Messages per outcome; every message has one."""
    return outcome_counts(_messy(spark, sf_dir))


_ROW_KEYS = "created_at,id,ncr_ride_bookings.csv/booking+value,ncr_ride_bookings.csv/ride+distance,updated_at,__op,__ts_ms"


@register("capture_records", f"""
WITH {EVENTS_CTE}, {MESSY_CTE}
SELECT part AS partition, off3 AS "offset",
       'business_postgres.' || CASE WHEN i % 31 IN (9, 10) THEN 'public.business_t' ELSE env_schema || '.' || env_table END AS topic,
       CASE WHEN i % 31 = 9 THEN 'x,y,z,__op,__ts_ms' WHEN i % 31 = 10 THEN '__op,__ts_ms'
            WHEN outcome = 'change' THEN '{_ROW_KEYS}' END AS keys,
       CASE WHEN i % 31 = 9 THEN '{{"x":null,"y":[1,2],"z":{{"k":"v"}},"__op":"c","__ts_ms":' || i || '}}'
            WHEN i % 31 = 10 THEN '{{"__op":"c","__ts_ms":' || i || '}}' END AS other_record,
       CASE WHEN i % 31 IN (9, 10) THEN i WHEN outcome = 'change' THEN env_ms + 500 END AS ts_ms
FROM messy WHERE outcome IN ('change', 'delete')
""")
def capture_records(spark, sf_dir):
    """Flat records of the capture hop on a topic with bad envelopes and tables of
    other columns: their keys in order, and the whole text of the other tables'."""
    rows = capture_to_topic(_messy(spark, sf_dir))
    text = F.col("value").cast("string")
    other = F.col("topic").endswith(".business_t")
    return rows.select("partition", "offset", "topic", F.array_join(F.json_object_keys(text), ",").alias("keys"),
                       F.when(other, text).alias("other_record"),
                       F.get_json_object(text, "$.__ts_ms").cast("long").alias("ts_ms"))


@register("stream_capture", f"""
WITH {EVENTS_CTE}, {MESSY_CTE}
SELECT CASE WHEN outcome IN {_REASONS} THEN 'rejected' ELSE 'changes' END AS sink, part AS partition, off3 AS "offset",
       CASE WHEN outcome IN {_REASONS} THEN outcome END AS reason, outcome = 'delete' AS is_tombstone
FROM messy WHERE outcome NOT IN ('snapshot', 'not included')
""")
def stream_capture(spark, sf_dir):
    """The capture hop as a stream with a sink for changes and one for rejected
    envelopes, fed from one parse of each batch; both read back."""
    src = TopicSource(topics=(ENVELOPE_TOPIC,), wire_path=_messy_path(spark, sf_dir), starting_offsets="earliest",
                      max_per_trigger=2)
    changes, rejected = (fresh_path(spark, "runs", n) for n in ("capture_changes", "capture_rejected"))
    run_available(start_capture_stream(spark, src, changes, rejected, trigger="availableNow"))
    good, bad = spark.read.parquet(changes), spark.read.parquet(rejected)
    return good.select(F.lit("changes").alias("sink"), "partition", "offset", F.lit(None).cast("string").alias("reason"),
                       F.col("value").isNull().alias("is_tombstone")).unionByName(
        bad.select(F.lit("rejected").alias("sink"), "partition", "offset", "reason", F.lit(False).alias("is_tombstone")))
