"""Shared fragments of the DuckDB oracles: the closed-form expectations of the
derived wire tables (see ``fixtures``), recomputed from ``events``."""

from ..constants import BOOKING_FIELD, CAPTURE_TOPIC, PRODUCER_TOPIC, RIDE_FIELD

# One row per event with the rule inputs the oracles need.
EVENTS_CTE = f"""
ev AS (
  SELECT event_id AS i, ts, user_id, event_type, value, props,
         (event_id % 23 = 0) AS tomb,
         (event_id % 23 = 0 OR event_id % 29 = 0) AS bad,
         epoch_us(ts) AS created_us,
         epoch_us(ts) + CASE WHEN event_id % 5 = 0 THEN 90000000 ELSE 0 END AS updated_us,
         CASE WHEN event_id % 5 = 0 THEN 'u' ELSE 'c' END AS op_code,
         CAST(event_id % 3 AS INTEGER) AS part,
         CAST(event_id // 3 AS BIGINT) AS off3,
         CAST(event_id // 6 AS BIGINT) AS off6,
         CASE WHEN event_id % 2 = 0 THEN '{CAPTURE_TOPIC}' ELSE '{PRODUCER_TOPIC}' END AS mixed_topic,
         (event_id // 2) % 24 AS kind
  FROM events
)"""

BOOKING_TEXT = ("CASE WHEN i % 7 = 0 THEN 'NULL' WHEN i % 3 = 0 THEN CAST(value AS VARCHAR) "
                "ELSE 'b''' || CAST(value AS VARCHAR) || '''' END")
_RIDE = "CAST(CAST(user_id AS DOUBLE) / 10 AS VARCHAR)"
RIDE_TEXT = (f"CASE WHEN i % 11 = 0 THEN 'NULL' WHEN i % 4 = 0 THEN '\"' || {_RIDE} || '\"' "
             f"WHEN i % 4 = 1 THEN 'b''' || {_RIDE} || '''' WHEN i % 4 = 2 THEN {_RIDE} "
             f"ELSE 'b''\"' || {_RIDE} || '\"''' END")

# The record's JSON text exactly as Spark's to_json writes it.
RECORD_JSON = (
    "'{\"id\":' || i || ',\"" + BOOKING_FIELD + "\":\"' || " + BOOKING_TEXT + " || '\",\""
    + RIDE_FIELD + "\":\"' || replace(" + RIDE_TEXT + ", '\"', '\\\"') || '\",\"event_type\":\"' || event_type"
    " || '\",\"user_id\":' || user_id || ',\"props\":' || to_json(props) || ',\"created_at\":' || created_us"
    " || ',\"updated_at\":' || updated_us || ',\"__op\":\"' || op_code || '\",\"__ts_ms\":' || (updated_us // 1000) || '}'"
)

CAPTURE_TEXT = f"CASE WHEN tomb THEN NULL WHEN i % 29 = 0 THEN '{{bad' ELSE {RECORD_JSON} END"

TS_TEXT = "strftime({0}, '%Y-%m-%d %H:%M:%S')"

# Producer-topic shapes by kind (see fixtures.producer_value_text).
TEST_JSON = ("'{\"id\":' || i || ',\"name\":\"Customer ' || user_id || '\",\"email\":\"user' || user_id"
             " || '@example.com\",\"timestamp\":\"' || strftime(ts, '%Y-%m-%dT%H:%M:%S')"
             " || '\",\"action\":\"test_message\"}'")
PRODUCER_SHAPES = [
    TEST_JSON, "'{}'", "'[]'", "'0'", "'\"\"'", "'false'", "'[1]'",
    "'\"' || event_type || '\"'", "'true'",
    "'{\"event_type\":\"' || event_type || '\",\"value\":' || CAST(value AS VARCHAR) || '}'",
    "'{\"op\":null,\"id\":' || i || '}'", "'{bad'", "'0.0'", "'\"0\"'", "'{\"x\":{\"op\":1}}'",
    "'[null]'", "'null'", "' {\"created_at\": ' || created_us || '} '",
    "'{\"op\":NaN}'", "'[NaN,-Infinity]'", "'Infinity'", "'{\"op\":1} x'", "'1,\"tideline end of message\"'",
    "'{\"text\":\"NaN\",\"op\":nan}'",
]
PRODUCER_REASONS = [
    "Valid JSON message", "Empty message", "Empty message", "Empty message", "Empty message",
    "Empty message", "Message is not a JSON object", "Message is not a JSON object",
    "Message is not a JSON object", "Valid JSON message (no timestamp field)", "Valid JSON message",
    "JSON validation error", "Empty message", "Message is not a JSON object",
    "Valid JSON message (no timestamp field)", "Message is not a JSON object", "Empty message",
    "Valid JSON message",
    "Valid JSON message", "Message is not a JSON object", "Message is not a JSON object", "JSON validation error",
    "JSON validation error", "JSON validation error",
]


def _case(items) -> str:
    return "CASE kind " + " ".join(f"WHEN {n} THEN {v}" for n, v in enumerate(items)) + " END"


PRODUCER_TEXT = _case(PRODUCER_SHAPES)
MIXED_TEXT = f"CASE WHEN tomb THEN NULL WHEN i % 2 = 0 THEN {CAPTURE_TEXT} ELSE {PRODUCER_TEXT} END"
MIXED_REASON = ("CASE WHEN tomb THEN 'Empty message' WHEN i % 2 = 0 THEN CASE WHEN i % 29 = 0 "
                "THEN 'JSON validation error' ELSE 'Valid JSON message' END ELSE "
                + _case([f"'{r}'" for r in PRODUCER_REASONS]) + " END")
VALID_OF = "({0} IN ('Valid JSON message', 'Valid JSON message (no timestamp field)'))"

# Envelope rules (see fixtures.envelope_wire).
ENV_CTE = """
env AS (
  SELECT *, CASE WHEN i % 10 = 0 THEN 'd' WHEN i % 10 = 1 THEN 'r' WHEN i % 10 <= 4 THEN 'u' ELSE 'c' END AS env_op,
         CASE WHEN i % 7 = 0 THEN 'staging' ELSE 'public' END AS env_schema,
         CASE i % 4 WHEN 0 THEN 'business_ncr_ride_bookings' WHEN 1 THEN 'business_' || event_type
                    WHEN 2 THEN event_type || '_log' ELSE 'xbusiness_' || event_type END AS env_table,
         epoch_us(ts) // 1000 AS env_ms
  FROM ev
),
cap AS (
  SELECT * FROM env WHERE regexp_full_match(env_schema || '.' || env_table, 'public.business_.*')
)"""

# Outcome of each message of the messy envelope topic (see fixtures.messy_envelope_wire).
MESSY_CTE = """
env AS (
  SELECT *, CASE WHEN i % 10 = 0 THEN 'd' WHEN i % 10 = 1 THEN 'r' WHEN i % 10 <= 4 THEN 'u' ELSE 'c' END AS env_op,
         CASE WHEN i % 7 = 0 THEN 'staging' ELSE 'public' END AS env_schema,
         CASE i % 4 WHEN 0 THEN 'business_ncr_ride_bookings' WHEN 1 THEN 'business_' || event_type
                    WHEN 2 THEN event_type || '_log' ELSE 'xbusiness_' || event_type END AS env_table,
         epoch_us(ts) // 1000 AS env_ms FROM ev
),
messy AS (
  SELECT *, CASE i % 31 WHEN 1 THEN 'no row state' WHEN 7 THEN 'no row state' WHEN 2 THEN 'no operation'
                        WHEN 3 THEN 'not an envelope' WHEN 5 THEN 'not an envelope' WHEN 6 THEN 'not an envelope'
                        WHEN 11 THEN 'not an envelope' WHEN 12 THEN 'not an envelope' WHEN 4 THEN 'no value'
                        WHEN 8 THEN 'unknown operation' WHEN 9 THEN 'change' WHEN 10 THEN 'change'
         ELSE CASE WHEN NOT regexp_full_match(env_schema || '.' || env_table, 'public.business_.*') THEN 'not included'
                   WHEN env_op = 'd' THEN 'delete' WHEN env_op = 'r' THEN 'snapshot' ELSE 'change' END END AS outcome
  FROM env
)"""

# CSV views (see fixtures.customer_view / orders_view / part_view).
CUST_V = """
cust_v AS (
  SELECT c_custkey AS k,
         CAST(c_custkey AS VARCHAR) AS "Customer Key",
         CASE WHEN c_custkey % 11 <> 0 THEN c_name END AS "Customer-Name",
         CAST(c_nationkey AS VARCHAR) AS "Nation Key",
         CASE WHEN c_custkey % 13 = 0 THEN 'NA' ELSE CAST(c_acctbal AS VARCHAR) END AS "Account Balance (USD)",
         CASE WHEN c_custkey % 17 <> 0 THEN c_mktsegment END AS "Market Segment",
         CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_acctbal > 0 THEN 'True' ELSE 'False' END AS "Active"
  FROM customer
)"""
ORD_V = """
ord_v AS (
  SELECT o_orderkey AS k,
         CAST(o_orderkey AS VARCHAR) AS "Booking ID",
         CAST(o_custkey AS VARCHAR) AS "Customer ID",
         o_orderstatus AS "Booking Status",
         CASE WHEN o_orderkey % 53 = 0 THEN 'NULL' ELSE CAST(o_totalprice AS VARCHAR) END AS "Booking Value",
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "Date",
         CASE WHEN o_orderkey % 41 <> 0 THEN o_orderpriority END AS "Priority (Level)"
  FROM orders
)"""
PART_V = """
part_v AS (
  SELECT p_partkey AS k,
         CAST(p_partkey AS VARCHAR) AS "Part Key", p_name AS "Name", p_brand AS "Brand", p_type AS "Type",
         CAST(p_size AS VARCHAR) AS "Size", CAST(p_retailprice AS VARCHAR) AS "Retail Price",
         CASE WHEN p_type LIKE 'PROMO%' THEN 'True' ELSE 'False' END AS "Promo"
  FROM part
)"""
# Free texts and bad records (see fixtures.note_view / messy_lines).
NOTE_CTE = """
notes AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS "Order Key",
         CASE WHEN o_orderkey % 11 = 0 THEN '  ' || o_orderpriority || ' ' WHEN o_orderkey % 7 = 0 THEN NULL
              WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 3 = 0 THEN 'say "' || o_orderpriority || '"'
              WHEN o_orderkey % 2 = 0 THEN o_orderpriority || chr(10) || chr(10) || 'second, line'
              ELSE o_orderpriority || ', more' END AS "Note (Text)",
         o_orderpriority AS "Priority"
  FROM orders
)"""
MESSY_CSV_CTE = """
messy AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS "Order Key",
         CASE WHEN o_orderkey % 43 = 0 THEN 'first' || chr(10) || 'second' ELSE 'note' END AS "Note", o_orderpriority AS "Priority",
         CASE WHEN o_orderkey % 37 = 0 OR o_orderkey % 41 = 0 THEN 'wrong number of fields' END AS reason,
         CASE WHEN o_orderkey % 37 = 0 THEN CAST(o_orderkey AS VARCHAR) || ',short'
              ELSE CAST(o_orderkey AS VARCHAR) || ',long,' || o_orderpriority || ',more' END AS bad
  FROM orders
)"""
CSV_VIEWS = f"{CUST_V}, {ORD_V}, {PART_V}"

# Typed customer table as the loader stores it.
CUST_TYPED = """
  CAST("Customer Key" AS INTEGER) AS "Customer_Key",
  COALESCE("Customer-Name", 'NULL') AS "Customer_Name",
  CAST("Nation Key" AS INTEGER) AS "Nation_Key",
  CAST(CASE WHEN "Account Balance (USD)" <> 'NA' THEN "Account Balance (USD)" END AS DECIMAL(15,4)) AS "Account_Balance_USD",
  COALESCE("Market Segment", 'NULL') AS "Market_Segment",
  COALESCE("Active", 'NULL') AS "Active"
"""
