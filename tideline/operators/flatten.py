"""Parse -> clean -> cast: flat change records on the wire to typed rows.

The same function serves a batch DataFrame (wire table) and a streaming one
(``readStream``): it is a single stateless projection, one stage, no shuffle.
Every input row yields exactly one output row; tombstones (null values) and
malformed JSON become all-NULL rows unless ``drop_tombstones`` is set.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import BOOKING_FIELD, OP_FIELD, RIDE_FIELD
from ..functions.cleaning import clean_byte_literal, to_double
from ..functions.timefmt import micros_to_text, micros_to_timestamp
from ..schemas import RECORD_SCHEMA


def decode_value(value: Column | str = "value") -> Column:
    """Message bytes -> UTF-8 text (NULL stays NULL)."""
    if isinstance(value, str):
        value = F.col(value)
    return value.cast("string")


def parse_records(wire: DataFrame, schema=RECORD_SCHEMA, keep: Sequence[str] = (),
                  value: str = "value", alias: str = "data") -> DataFrame:
    """Decode and parse each message once into the struct ``data``.  Unknown
    fields are ignored; unparseable input gives a struct of NULLs."""
    return wire.select(*keep, F.from_json(decode_value(value), schema).alias(alias))


def flatten_columns(data: str = "data", typed_time: bool = False) -> list[Column]:
    d = F.col(data)
    cols = [
        d.getField("id").alias("id"),
        d.getField(OP_FIELD).alias("op"),
        micros_to_text(d.getField("created_at")).alias("created_at_ts"),
        micros_to_text(d.getField("updated_at")).alias("updated_at_ts"),
        to_double(clean_byte_literal(d.getField(BOOKING_FIELD))).alias("booking_value"),
        to_double(clean_byte_literal(d.getField(RIDE_FIELD))).alias("ride_distance"),
    ]
    if typed_time:
        cols += [micros_to_timestamp(d.getField("created_at")).alias("created_at"),
                 micros_to_timestamp(d.getField("updated_at")).alias("updated_at")]
    return cols


def flatten_changes(wire: DataFrame, *, keep: Sequence[str] = (), processed_at: bool = True,
                    typed_time: bool = False, drop_tombstones: bool = False) -> DataFrame:
    """Wire rows (``value`` binary or string) -> ``id, op, created_at_ts,
    updated_at_ts, booking_value, ride_distance[, processed_at]``.

    ``keep`` passes wire columns (e.g. topic, partition, offset) through;
    ``typed_time`` adds typed ``created_at``/``updated_at`` timestamps next to
    the text ones."""
    src = wire.where(F.col("value").isNotNull()) if drop_tombstones else wire
    parsed = parse_records(src, keep=keep)
    cols = [F.col(k) for k in keep] + flatten_columns("data", typed_time)
    if processed_at:
        cols.append(F.current_timestamp().alias("processed_at"))
    return parsed.select(*cols)
