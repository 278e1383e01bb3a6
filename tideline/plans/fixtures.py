"""Inputs derived from the given tables.

The wire tables stand in for the message topics: they carry the columns of
Spark's Kafka source and are computed from ``events`` row by row, so their
size grows with the data.  Each rule is closed-form in ``event_id`` (``i``),
which is what lets the SQL oracles recompute the expected results directly
from ``events`` without parsing any JSON.

Capture topic (one row per event):
  partition = i % 3, offset = floor(i / 3), timestamp = ts
  value: i % 23 = 0 -> NULL (tombstone); i % 29 = 0 -> ``{bad``; else the
  flat change record below, as JSON bytes.
Record: id = i; booking text: i % 7 = 0 -> ``NULL``, i % 3 = 0 -> value,
  else ``b'<value>'``; ride text (user_id / 10): i % 11 = 0 -> ``NULL``, then
  by i % 4: ``"x"``, ``b'x'``, ``x``, ``b'"x"'``; created_at = micros(ts);
  updated_at = created_at + 90 s when i % 5 = 0; __op = 'u' when i % 5 = 0
  else 'c'; __ts_ms = updated_at in ms; event_type, user_id, props passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import (BOOKING_FIELD, CAPTURE_TOPIC, PRODUCER_TOPIC, RIDE_FIELD,
                         TEST_ACTION)
from ..functions.timefmt import ts_to_micros
from ..operators.ids import by_ranges

UPDATE_SHIFT_US = 90_000_000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_ordered(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A given table whose row order matters downstream (CSV files that are
    numbered in input order): ranges of the key, sorted within, so that the
    order of the files is the order of the key whatever the input's layout."""
    return by_ranges(load(spark, sf_dir, name), [key]).sortWithinPartitions(key)


def _i() -> Column:
    return F.col("event_id")


def _div(c: Column, n: int) -> Column:
    return ((c - c % n) / n).cast("long")


def booking_text() -> Column:
    i, v = _i(), F.col("value").cast("string")
    return (F.when(i % 7 == 0, F.lit("NULL")).when(i % 3 == 0, v)
            .otherwise(F.concat(F.lit("b'"), v, F.lit("'"))))


def ride_text() -> Column:
    i, v = _i(), (F.col("user_id") / 10.0).cast("string")
    return (F.when(i % 11 == 0, F.lit("NULL"))
            .when(i % 4 == 0, F.concat(F.lit('"'), v, F.lit('"')))
            .when(i % 4 == 1, F.concat(F.lit("b'"), v, F.lit("'")))
            .when(i % 4 == 2, v)
            .otherwise(F.concat(F.lit("b'\""), v, F.lit("\"'"))))


def record_struct() -> Column:
    i = _i()
    created = ts_to_micros(F.col("ts"))
    updated = created + F.when(i % 5 == 0, F.lit(UPDATE_SHIFT_US)).otherwise(F.lit(0))
    return F.struct(
        i.alias("id"),
        booking_text().alias(BOOKING_FIELD),
        ride_text().alias(RIDE_FIELD),
        F.col("event_type"), F.col("user_id"), F.col("props"),
        created.alias("created_at"),
        updated.alias("updated_at"),
        F.when(i % 5 == 0, F.lit("u")).otherwise(F.lit("c")).alias("__op"),
        _div(updated, 1000).alias("__ts_ms"),
    )


def capture_value_text() -> Column:
    i = _i()
    return (F.when(i % 23 == 0, F.lit(None).cast("string"))
            .when(i % 29 == 0, F.lit("{bad"))
            .otherwise(F.to_json(record_struct())))


def _wire(events: DataFrame, topic: Column, value_text: Column, offset: Column) -> DataFrame:
    i = _i()
    return events.select(
        F.to_json(F.struct(i.alias("id"))).cast("binary").alias("key"),
        value_text.cast("binary").alias("value"),
        topic.alias("topic"),
        (i % 3).cast("int").alias("partition"),
        offset.alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def capture_wire(events: DataFrame) -> DataFrame:
    """The capture topic: every event as one flat change record."""
    return _wire(events, F.lit(CAPTURE_TOPIC), capture_value_text(), _div(_i(), 3))


# Producer-topic message shapes, chosen by (i div 2) % 24 for odd i; the SQL
# oracles spell out the expected validation reason for each.
def producer_value_text() -> Column:
    i = _i()
    k = _div(i, 2) % 24
    test_msg = F.to_json(F.struct(
        i.alias("id"),
        F.concat(F.lit("Customer "), F.col("user_id").cast("string")).alias("name"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("email"),
        F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.lit(TEST_ACTION).alias("action")))
    shapes = [
        test_msg,
        F.lit("{}"), F.lit("[]"), F.lit("0"), F.lit('""'), F.lit("false"),
        F.lit("[1]"), F.concat(F.lit('"'), F.col("event_type"), F.lit('"')), F.lit("true"),
        F.to_json(F.struct(F.col("event_type"), F.col("value"))),
        F.concat(F.lit('{"op":null,"id":'), i.cast("string"), F.lit("}")),
        F.lit("{bad"), F.lit("0.0"), F.lit('"0"'), F.lit('{"x":{"op":1}}'),
        F.lit("[null]"), F.lit("null"),
        F.concat(F.lit(' {"created_at": '), ts_to_micros(F.col("ts")).cast("string"), F.lit("} ")),
        F.lit('{"op":NaN}'), F.lit("[NaN,-Infinity]"), F.lit("Infinity"), F.lit('{"op":1} x'),
        F.lit('1,"tideline end of message"'), F.lit('{"text":"NaN","op":nan}'),
    ]
    expr = F.when(i % 23 == 0, F.lit(None).cast("string"))
    for n, shape in enumerate(shapes):
        expr = expr.when(k == n, shape)
    return expr


def mixed_wire(events: DataFrame) -> DataFrame:
    """Two topics: even events carry capture records, odd ones the producer
    topic's assorted messages.  Offsets are contiguous per topic-partition."""
    i = _i()
    topic = F.when(i % 2 == 0, F.lit(CAPTURE_TOPIC)).otherwise(F.lit(PRODUCER_TOPIC))
    value = F.when(i % 2 == 0, capture_value_text()).otherwise(producer_value_text())
    return _wire(events, topic, value, _div(i, 6))


# Change envelopes as the capture connector emits them (before unwrapping),
# on one raw topic with the capture wire's partition/offset rules.
#   op by i % 10: 0 -> d, 1 -> r, 2..4 -> u, else c
#   source.schema: 'staging' when i % 7 = 0 else 'public'
#   source.table by i % 4: business_ncr_ride_bookings, business_<event_type>,
#                          <event_type>_log, xbusiness_<event_type>
#   before = row for d; after = row otherwise; ts_ms = ms(ts) + 500
ENVELOPE_TOPIC = "business_postgres.raw_changes"


def envelope_op() -> Column:
    k = _i() % 10
    return (F.when(k == 0, F.lit("d")).when(k == 1, F.lit("r"))
            .when(k <= 4, F.lit("u")).otherwise(F.lit("c")))


def envelope_wire(events: DataFrame) -> DataFrame:
    i = _i()
    rec = record_struct()
    row = F.struct(*[rec.getField(n).alias(n) for n in
                     ("id", BOOKING_FIELD, RIDE_FIELD, "created_at", "updated_at")])
    ms = _div(ts_to_micros(F.col("ts")), 1000)
    t = F.col("event_type")
    table = (F.when(i % 4 == 0, F.lit("business_ncr_ride_bookings"))
             .when(i % 4 == 1, F.concat(F.lit("business_"), t))
             .when(i % 4 == 2, F.concat(t, F.lit("_log")))
             .otherwise(F.concat(F.lit("xbusiness_"), t)))
    op = envelope_op()
    env = F.struct(
        F.when(op == "d", row).alias("before"),
        F.when(op != "d", row).alias("after"),
        F.struct(F.lit("business_db").alias("db"),
                 F.when(i % 7 == 0, F.lit("staging")).otherwise(F.lit("public")).alias("schema"),
                 table.alias("table"), ms.alias("ts_ms")).alias("source"),
        op.alias("op"),
        (ms + 500).alias("ts_ms"))
    return _wire(events, F.lit(ENVELOPE_TOPIC), F.to_json(env), _div(i, 3))


# The same topic with messages a capture hop must not lose or break on, by i % 31:
#   1 -> ``"after": null``        2 -> no ``op``            3 -> ``{bad``           4 -> NULL
#   5 -> ``[1,2]``                6 -> ``null``             7 -> no ``after``       8 -> ``"op":"t"``
#   9 -> a table of other columns (one null, a list, an object; keys in another order)
#   10 -> ``"after": {}``         11 -> ``{"a":1}``         12 -> the envelope cut off in the middle
# else the envelope of envelope_wire.
def messy_envelope_wire(events: DataFrame) -> DataFrame:
    wire = envelope_wire(events).withColumn("_i", F.get_json_object(F.col("key").cast("string"), "$.id").cast("long"))
    k, text = F.col("_i") % 31, F.col("value").cast("string")

    def custom(op: str, after: str) -> Column:
        return F.concat(F.lit('{"before":null' + after + ',"source":{"db":"d","schema":"public","table":"business_t"},'
                              + op + '"ts_ms":'), F.col("_i").cast("string"), F.lit("}"))
    c = '"op":"c",'
    shapes = {1: custom(c, ',"after":null'), 2: custom("", ',"after":{"x":1}'), 3: F.lit("{bad"),
              4: F.lit(None).cast("string"), 5: F.lit("[1,2]"), 6: F.lit("null"), 7: custom(c, ""),
              8: custom('"op":"t",', ',"after":{"x":1}'), 9: custom(c, ',"after":{"z":{"k":"v"},"y":[1,2],"x":null}'),
              10: custom(c, ',"after":{}'), 11: F.lit('{"a":1}'), 12: F.left(text, F.length(text) - 20)}
    value = text
    for n, shape in shapes.items():
        value = F.when(k == n, shape).otherwise(value)
    return wire.withColumn("value", value.cast("binary")).drop("_i")


# --- CSV datasets derived from the TPC-H-style tables --------------------------
# All columns are text, headers carry spaces, hyphens and parentheses, and
# missing values are injected by key:
#   customer: name NULL when key % 11 = 0; balance 'NA' when % 13 = 0;
#             segment NULL when % 17 = 0; Active NULL when % 19 = 0,
#             else 'True' when balance > 0 else 'False'
#   orders:   value 'NULL' when key % 53 = 0; priority NULL when % 41 = 0
#   part:     Promo 'True' when the type starts with PROMO else 'False'
def _txt(c: str) -> Column:
    return F.col(c).cast("string")


def customer_view(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        _txt("c_custkey").alias("Customer Key"),
        F.when(k % 11 != 0, F.col("c_name")).alias("Customer-Name"),
        _txt("c_nationkey").alias("Nation Key"),
        F.when(k % 13 == 0, F.lit("NA")).otherwise(_txt("c_acctbal")).alias("Account Balance (USD)"),
        F.when(k % 17 != 0, F.col("c_mktsegment")).alias("Market Segment"),
        F.when(k % 19 == 0, F.lit(None).cast("string")).when(F.col("c_acctbal") > 0, F.lit("True"))
        .otherwise(F.lit("False")).alias("Active"),
    )


def orders_view(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return orders.select(
        _txt("o_orderkey").alias("Booking ID"),
        _txt("o_custkey").alias("Customer ID"),
        F.col("o_orderstatus").alias("Booking Status"),
        F.when(k % 53 == 0, F.lit("NULL")).otherwise(_txt("o_totalprice")).alias("Booking Value"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("Date"),
        F.when(k % 41 != 0, F.col("o_orderpriority")).alias("Priority (Level)"),
    )


def part_view(part: DataFrame) -> DataFrame:
    return part.select(
        _txt("p_partkey").alias("Part Key"), F.col("p_name").alias("Name"),
        F.col("p_brand").alias("Brand"), F.col("p_type").alias("Type"),
        _txt("p_size").alias("Size"), _txt("p_retailprice").alias("Retail Price"),
        F.when(F.col("p_type").startswith("PROMO"), F.lit("True")).otherwise(F.lit("False"))
        .alias("Promo"),
    )


# Free texts by key: % 2 = 0 -> a line break inside, % 3 = 0 -> quotes, % 5 = 0 -> empty, % 7 = 0 -> missing,
# % 11 = 0 -> blanks around, else a delimiter; the first rule that holds counts, from the last.
def note_view(orders: DataFrame) -> DataFrame:
    k, p = F.col("o_orderkey"), F.col("o_orderpriority")
    note = (F.when(k % 11 == 0, F.concat(F.lit("  "), p, F.lit(" "))).when(k % 7 == 0, F.lit(None).cast("string"))
            .when(k % 5 == 0, F.lit("")).when(k % 3 == 0, F.concat(F.lit('say "'), p, F.lit('"')))
            .when(k % 2 == 0, F.concat(p, F.lit("\n\nsecond, line")))
            .otherwise(F.concat(p, F.lit(", more"))))
    return orders.select(_txt("o_orderkey").alias("Order Key"), note.alias("Note (Text)"), p.alias("Priority"))


# Raw lines of a dataset with bad records by key: % 37 = 0 -> two fields, % 41 = 0 -> four, % 43 = 0 -> a note of
# two lines, else three fields.
RAW_LINES = {"header": "true", "sep": "\u0001", "quote": "", "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}


def messy_lines(orders: DataFrame) -> DataFrame:
    k, key, p = F.col("o_orderkey"), _txt("o_orderkey"), F.col("o_orderpriority")
    lines = (F.when(k % 37 == 0, F.array(F.concat(key, F.lit(",short"))))
             .when(k % 41 == 0, F.array(F.concat(key, F.lit(",long,"), p, F.lit(",more"))))
             .when(k % 43 == 0, F.array(F.concat(key, F.lit(',"first')), F.concat(F.lit('second",'), p)))
             .otherwise(F.array(F.concat(key, F.lit(",note,"), p))))
    return orders.select(F.explode(lines).alias("Order Key,Note,Priority"))


def text_view(df: DataFrame) -> DataFrame:
    return df.select(*[_txt(c).alias(c) for c in df.columns])


# dataset name -> (source table, view builder); the first two match the
# downloaded-file pattern, the others are loaded as local files.
CSV_DATASETS = {
    "ncr_ride_bookings": ("orders", "o_orderkey", orders_view),
    "ncr_ride_bookings_customers": ("customer", "c_custkey", customer_view),
    "parts": ("part", "p_partkey", part_view),
    "regions": ("region", "r_regionkey", text_view),
    "nations": ("nation", "n_nationkey", text_view),
    "suppliers": ("supplier", "s_suppkey", text_view),
}
LOCAL_FILES = ("parts.csv", "regions.csv", "nations.csv", "suppliers.csv", "missing.csv")
