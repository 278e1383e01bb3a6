"""Schemas of the wire (topic) rows, the flat change record and the capture
envelope."""

from pyspark.sql import types as T

from .constants import BOOKING_FIELD, OP_FIELD, RIDE_FIELD

# Columns of Spark's Kafka source; a parquet "wire table" carries the same.
WIRE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("timestampType", T.IntegerType(), True),
])

# Fixed names and types: the six fields the streaming job reads from each flat change record; any
# other field in the JSON is ignored.
RECORD_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("created_at", T.LongType(), True),
    T.StructField("updated_at", T.LongType(), True),
    T.StructField(OP_FIELD, T.StringType(), True),
    T.StructField(BOOKING_FIELD, T.StringType(), True),
    T.StructField(RIDE_FIELD, T.StringType(), True),
])

ROW_STATE = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField(BOOKING_FIELD, T.StringType(), True),
    T.StructField(RIDE_FIELD, T.StringType(), True),
    T.StructField("created_at", T.LongType(), True),
    T.StructField("updated_at", T.LongType(), True),
])

SOURCE_INFO = T.StructType([
    T.StructField("db", T.StringType(), True),
    T.StructField("schema", T.StringType(), True),
    T.StructField("table", T.StringType(), True),
    T.StructField("ts_ms", T.LongType(), True),
])

# Row-change envelope as the capture connector emits it before unwrapping.  The
# row states are kept whole, whatever columns their table has.
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("before", T.VariantType(), True),
    T.StructField("after", T.VariantType(), True),
    T.StructField("source", SOURCE_INFO, True),
    T.StructField("op", T.StringType(), True),
    T.StructField("ts_ms", T.LongType(), True),
])

# Output of the flattening job (processed_at is optional and excluded from
# oracle comparisons).
FLAT_COLUMNS = ("id", "op", "created_at_ts", "updated_at_ts", "booking_value",
                "ride_distance")
