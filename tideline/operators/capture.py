"""Row-change capture semantics on a DataFrame of change envelopes.

Envelope (``before, after, source{db,schema,table,ts_ms}, op, ts_ms``) ->
table include filter -> unwrap to the new row state with ``__op``/``__ts_ms``
-> topic ``<prefix>.<schema>.<table>`` -> flat JSON wire rows.  Deletes are
dropped and leave their tombstone (a NULL value with the row's key);
snapshot reads (``r``) are not emitted.  Everything is one projection and
filter per row: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import (DELETE_HANDLING, DROP_TOMBSTONES, SNAPSHOT_MODE, TABLE_INCLUDE_LIST,
                         TOPIC_PREFIX)
from ..schemas import ENVELOPE_SCHEMA
from .flatten import decode_value


def parse_envelopes(wire: DataFrame, schema=ENVELOPE_SCHEMA,
                    include: str | None = TABLE_INCLUDE_LIST) -> DataFrame:
    """Adds the parsed envelope as struct ``env`` and, with ``include``, keeps
    only changes of matching tables.

    Parse and filter happen in one generator step (``inline`` over a
    one-element array filtered on the parsed value): a plain ``where`` on a
    parsed column would be pushed below the parsing projection and parse
    every message twice."""
    env = F.from_json(decode_value("value"), schema)
    one = F.array(F.struct(*[F.col(f"`{c}`") for c in wire.columns], env.alias("env")))
    if include is not None:
        one = F.filter(one, lambda r: table_matches(r["env"]["source"]["schema"],
                                                    r["env"]["source"]["table"], include))
    return wire.select(F.inline(one))


def table_matches(schema_name, table, include: str = TABLE_INCLUDE_LIST):
    """Whole-name regex match on ``<schema>.<table>``."""
    return F.concat_ws(".", schema_name, table).rlike(f"^(?:{include})$")


def unwrap_envelopes(env_df: DataFrame, *, delete_handling: str = DELETE_HANDLING,
                     drop_tombstones: bool = DROP_TOMBSTONES,
                     snapshot_mode: str = SNAPSHOT_MODE,
                     add_fields=("op", "ts_ms")) -> DataFrame:
    """Adds ``record``: the whole new row state as JSON text (every column, nulls
    included) plus ``__<field>`` metadata, or NULL for a delete's tombstone.
    Envelopes without a usable change are left out; :func:`rejected_envelopes`
    lists them."""
    if delete_handling != "drop":
        raise ValueError("only delete_handling='drop' is supported")
    op = F.col("env.op")
    env_df = env_df.withColumn("_state", F.to_json(F.col("env.after")))
    state = F.col("_state")
    ops = ["c", "u"] + ([] if snapshot_mode == "never" else ["r"])
    keep = op.isin(ops) & state.startswith("{")         # the others are in rejected_envelopes
    if not drop_tombstones:
        keep = keep | (op == "d")
    return env_df.where(keep).withColumn("record", record_text(op, state, add_fields)).drop("_state")


def record_text(op: Column, state: Column, add_fields=("op", "ts_ms"), env: str = "env") -> Column:
    """The row state's JSON text with ``__<field>`` metadata; NULL for a delete."""
    extra = F.to_json(F.struct(*[F.col(env).getField(a).alias(f"__{a}") for a in add_fields]),
                      {"ignoreNullFields": "false"})
    joined = F.concat(F.left(state, F.length(state) - 1), F.lit(","), F.substring(extra, 2, 1 << 30))
    return F.when(op != "d", F.when(state == "{}", extra).otherwise(joined))


# What becomes of a message on the raw topic.  A message has one outcome, so their counts add up to the topic.
CHANGE, DELETE, SNAPSHOT, SKIPPED = "change", "delete", "snapshot", "not included"
REJECTED = ("no value", "not an envelope", "no operation", "unknown operation", "no row state")
_MALFORMED = "_malformed"
_JUDGED = T.StructType([*ENVELOPE_SCHEMA.fields, T.StructField(_MALFORMED, T.StringType())])


def _outcome(value: Column, env: Column, include: str | None) -> Column:
    op, src = env["op"], env["source"]
    seen = ~env.isNull() & env[_MALFORMED].isNull() & src["schema"].isNotNull() & src["table"].isNotNull()
    skipped = ~table_matches(src["schema"], src["table"], include) if include is not None else F.lit(False)
    return (F.when(value.isNull(), REJECTED[0]).when(~F.coalesce(seen, F.lit(False)), REJECTED[1])
            .when(skipped, SKIPPED).when(op.isNull(), REJECTED[2]).when(op == "d", DELETE).when(op == "r", SNAPSHOT)
            .when(~op.isin("c", "u"), REJECTED[3])
            .when(F.coalesce(F.to_json(env["after"]).startswith("{"), F.lit(False)), CHANGE).otherwise(REJECTED[4]))


def judge_envelopes(wire: DataFrame, include: str | None = TABLE_INCLUDE_LIST) -> DataFrame:
    """Every message with its parsed envelope ``env`` and its ``outcome``:
    ``change``, ``delete``, ``snapshot``, ``not included`` or one of ``REJECTED``.
    Parsed once, in the same generator step as :func:`parse_envelopes`."""
    env = F.from_json(decode_value("value"), _JUDGED, {"columnNameOfCorruptRecord": _MALFORMED})
    one = F.array(F.struct(*[F.col(f"`{c}`") for c in wire.columns], env.alias("env")))
    judged = F.transform(one, lambda r: F.struct(
        *[r[c].alias(c) for c in wire.columns], r["env"].alias("env"),
        _outcome(r["value"], r["env"], include).alias("outcome")))
    return wire.select(F.inline(judged))


def captured_rows(wire: DataFrame, *, prefix: str = TOPIC_PREFIX, include: str | None = TABLE_INCLUDE_LIST) -> DataFrame:
    """Every message as a wire row with its ``outcome``: changes and deletes carry
    the flat record (a delete: NULL) on their routed topic, the others their own
    value and topic.  One parse serves the sink of changes and that of rejects."""
    judged = judge_envelopes(wire, include).withColumn("_state", F.to_json(F.col("env.after")))
    emitted = F.col("outcome").isin(CHANGE, DELETE)
    record = record_text(F.col("env.op"), F.col("_state")).cast("binary")
    return judged.select("key", F.when(emitted, record).otherwise(F.col("value")).alias("value"),
                         F.when(emitted, route_topic(prefix)).otherwise(F.col("topic")).alias("topic"),
                         "partition", "offset", "timestamp", "timestampType", "outcome")


def rejected_envelopes(wire: DataFrame, include: str | None = TABLE_INCLUDE_LIST) -> DataFrame:
    """``topic, partition, offset, reason`` of the messages that carry no usable
    change: no value (a tombstone already), not an envelope (malformed, or
    without the table it is about), no or an unknown operation, or a change
    without the new row state."""
    return judge_envelopes(wire, include).where(F.col("outcome").isin(*REJECTED)).select(
        "topic", "partition", "offset", F.col("outcome").alias("reason"))


def outcome_counts(wire: DataFrame, include: str | None = TABLE_INCLUDE_LIST) -> DataFrame:
    """Messages per topic and outcome; the counts of a topic add up to its messages."""
    return judge_envelopes(wire, include).groupBy("topic", "outcome").agg(F.count(F.lit(1)).alias("messages"))


def route_topic(prefix: str = TOPIC_PREFIX):
    src = F.col("env.source")
    return F.concat_ws(".", F.lit(prefix), src.getField("schema"), src.getField("table"))


def capture_to_topic(wire: DataFrame, *, prefix: str = TOPIC_PREFIX,
                     include: str = TABLE_INCLUDE_LIST, **unwrap_kw) -> DataFrame:
    """Envelope wire rows -> flat-record wire rows on the routed topics.
    Partition and offset are carried over, so per-key order is kept."""
    flat = unwrap_envelopes(parse_envelopes(wire, include=include), **unwrap_kw)
    return flat.select(
        "key",
        F.col("record").cast("binary").alias("value"),
        route_topic(prefix).alias("topic"),
        "partition", "offset", "timestamp", "timestampType",
    )
