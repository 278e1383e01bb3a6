"""Queries over the capture topic: flattening and its scalar steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import BOOKING_FIELD, OP_FIELD, RIDE_FIELD
from ..functions.cleaning import clean_byte_literal, to_double
from ..functions.timefmt import micros_to_text, micros_to_timestamp
from ..operators.flatten import flatten_changes, parse_records
from .fixtures import capture_wire, load
from .registry import register
from .staging import staged_wire
from .sqlparts import BOOKING_TEXT, EVENTS_CTE, RIDE_TEXT, TS_TEXT


def captured(spark, sf_dir):
    return staged_wire(spark, sf_dir, "capture_wire", lambda: capture_wire(load(spark, sf_dir, "events")))


FLAT_ORACLE = f"""
WITH {EVENTS_CTE}
SELECT CASE WHEN NOT bad THEN i END AS id,
       CASE WHEN NOT bad THEN op_code END AS op,
       CASE WHEN NOT bad THEN {TS_TEXT.format('ts')} END AS created_at_ts,
       CASE WHEN NOT bad THEN {TS_TEXT.format("ts + to_microseconds(updated_us - created_us)")} END AS updated_at_ts,
       CASE WHEN NOT bad AND i % 7 <> 0 THEN value END AS booking_value,
       CASE WHEN NOT bad AND i % 11 <> 0 THEN CAST(user_id AS DOUBLE) / 10 END AS ride_distance
FROM ev
"""


@register("cdc_flatten", FLAT_ORACLE)
def cdc_flatten(spark, sf_dir):
    """Flagship: capture topic -> parse -> clean -> cast (one output row per
    message; tombstones and malformed messages give all-NULL rows)."""
    wire = captured(spark, sf_dir)
    return flatten_changes(wire, processed_at=False)


@register("cdc_parse", f"""
WITH {EVENTS_CTE}
SELECT part AS partition, off3 AS "offset", CASE WHEN NOT bad THEN i END AS id,
       CASE WHEN NOT bad THEN op_code END AS op, CASE WHEN NOT bad THEN created_us END AS created_at,
       CASE WHEN NOT bad THEN updated_us END AS updated_at,
       CASE WHEN NOT bad THEN {BOOKING_TEXT} END AS booking_text, CASE WHEN NOT bad THEN {RIDE_TEXT} END AS ride_text
FROM ev
""")
def cdc_parse(spark, sf_dir):
    """The six fields of each change record, special names included."""
    d = F.col("data")
    return parse_records(captured(spark, sf_dir), keep=("partition", "offset")).select(
        "partition", "offset", d.getField("id").alias("id"), d.getField(OP_FIELD).alias("op"),
        d.getField("created_at").alias("created_at"), d.getField("updated_at").alias("updated_at"),
        d.getField(BOOKING_FIELD).alias("booking_text"), d.getField(RIDE_FIELD).alias("ride_text"))


@register("clean_values", f"""
WITH {EVENTS_CTE}, c AS (
  SELECT i, CASE WHEN bad THEN NULL WHEN i % 7 = 0 THEN 'NULL' ELSE CAST(value AS VARCHAR) END AS booking_clean,
         CASE WHEN bad THEN NULL WHEN i % 11 = 0 THEN 'NULL' ELSE CAST(CAST(user_id AS DOUBLE) / 10 AS VARCHAR) END
         AS ride_clean FROM ev)
SELECT part AS partition, off3 AS "offset", booking_clean, TRY_CAST(booking_clean AS DOUBLE) AS booking_value,
       ride_clean, TRY_CAST(ride_clean AS DOUBLE) AS ride_distance
FROM c JOIN ev USING (i)
""")
def clean_values(spark, sf_dir):
    """Byte-literal texts stripped, and as doubles (other text -> NULL)."""
    d = F.col("data")
    booking, ride = (clean_byte_literal(d.getField(f)) for f in (BOOKING_FIELD, RIDE_FIELD))
    return parse_records(captured(spark, sf_dir), keep=("partition", "offset")).select(
        "partition", "offset", booking.alias("booking_clean"), to_double(booking).alias("booking_value"),
        ride.alias("ride_clean"), to_double(ride).alias("ride_distance"))


@register("micros_to_ts", f"""
WITH {EVENTS_CTE}
SELECT part AS partition, off3 AS "offset", CASE WHEN NOT bad THEN {TS_TEXT.format('ts')} END AS created_at_ts,
       CASE WHEN NOT bad THEN created_us END AS created_us
FROM ev
""")
def micros_to_ts(spark, sf_dir):
    """Epoch micros as text and as a typed timestamp (shown by its micros)."""
    created = F.col("data").getField("created_at")
    return parse_records(captured(spark, sf_dir), keep=("partition", "offset")).select(
        "partition", "offset", micros_to_text(created).alias("created_at_ts"),
        F.unix_micros(micros_to_timestamp(created)).alias("created_us"))
