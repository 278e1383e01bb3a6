"""Message validation.

A message is judged the way a Python consumer judges ``json.loads(value)``:
falsy values (null, empty text, ``{}``, ``[]``, ``0``, ``""``, ``false``) are
empty; anything but an object is rejected; objects are valid, and say whether
one of the timestamp keys is present (presence counts, a null value too).
Unparseable text gets the error reason and the stream goes on.

Cost: one full parse (validity) per message, one key scan per object and an
element count per array, each in its own projection so Catalyst never
evaluates them twice; the root kind comes from the first significant
character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (REASON_EMPTY, REASON_ERROR, REASON_NOT_OBJECT, REASON_VALID,
                         REASON_VALID_NO_TS, TIMESTAMP_KEYS)

JSON_WS = " \t\n\r"
END_MARK = "tideline end of message"
ZERO_RE = r"^-?0(\.0+)?([eE][+-]?[0-9]+)?$"


#: Numbers that a Python consumer reads and JSON does not know; a text that holds one is parsed a second time.
NON_NUMBER = r"(?:^|[\s\[{:,])(?:NaN|-?Infinity)(?:$|[\s\]},])"
NON_NUMERIC = {"allowNonNumericNumbers": "true"}


def _marked(text: Column) -> Column:
    """The text as the first of two array items, so that what follows its value does not pass unread."""
    return F.concat(F.lit("["), text, F.lit(f'\n,"{END_MARK}"]'))


def _lenient(text: Column) -> Column:
    items = F.from_json(_marked(text), "array<string>", NON_NUMERIC)
    return (F.size(items) == 2) & (F.get(items, F.lit(1)) == END_MARK) & ~text.rlike(r"[+]Infinity|\bINF\b")


def _trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(JSON_WS))


def first_char(text: Column) -> Column:
    return F.substring(F.ltrim(text, F.lit(JSON_WS)), 1, 1)


def kind_of_first(first: Column) -> Column:
    """Root kind from the first significant character: object, array,
    string, boolean, null, number; NULL for NULL/blank text."""
    return (F.when(first == "{", "object").when(first == "[", "array")
            .when(first == '"', "string").when(first.isin("t", "f"), "boolean")
            .when(first == "n", "null").when(first.rlike(r"^[-0-9]$"), "number"))


def add_validation(df: DataFrame, text: str) -> DataFrame:
    """Adds ``reason`` (and nothing else) for the JSON text column ``text``."""
    t = F.col(text)
    staged = (df.withColumn("_first", first_char(t))
              .withColumn("_kind", kind_of_first(F.col("_first")))
              # as the first of two array items, so that text after the value does not pass unread
              .withColumn("_v", F.try_parse_json(_marked(t)))
              .withColumn("_odd", F.col("_v").isNull() & t.rlike(NON_NUMBER))
              .withColumn("_ok", F.coalesce(
                  F.when(F.col("_odd"), _lenient(t)).otherwise(
                      (F.try_variant_get("_v", "$[1]", "string") == END_MARK)
                      & F.try_variant_get("_v", "$[2]", "string").isNull()), F.lit(False)))
              .withColumn("_keys", F.when((F.col("_kind") == "object") & F.col("_ok"), F.when(
                  F.col("_odd"), F.map_keys(F.from_json(t, "map<string,string>", NON_NUMERIC))).otherwise(
                  F.json_object_keys(t)))))
    kind, keys = F.col("_kind"), F.col("_keys")
    has_ts = F.exists(keys, lambda k: k.isin(list(TIMESTAMP_KEYS)))
    reason = (
        F.when(t.isNull() | (t == ""), F.lit(REASON_EMPTY))
        .when(~F.col("_ok"), F.lit(REASON_ERROR))
        .when(kind == "object", F.when(F.size(keys) == 0, F.lit(REASON_EMPTY))
              .when(has_ts, F.lit(REASON_VALID)).otherwise(F.lit(REASON_VALID_NO_TS)))
        .when(kind == "array", F.when(F.json_array_length(t) == 0, F.lit(REASON_EMPTY))
              .otherwise(F.lit(REASON_NOT_OBJECT)))
        .when(kind == "string", F.when(_trimmed(t) == '""', F.lit(REASON_EMPTY))
              .otherwise(F.lit(REASON_NOT_OBJECT)))
        .when(kind == "null", F.lit(REASON_EMPTY))
        .when(kind == "boolean", F.when(_trimmed(t) == "false", F.lit(REASON_EMPTY))
              .otherwise(F.lit(REASON_NOT_OBJECT)))
        .otherwise(F.when(_trimmed(t).rlike(ZERO_RE), F.lit(REASON_EMPTY))
                   .otherwise(F.lit(REASON_NOT_OBJECT)))
    )
    return staged.withColumn("reason", reason).drop("_first", "_kind", "_ok", "_keys", "_v", "_odd")


def is_valid_reason(reason: Column) -> Column:
    return reason.isin(REASON_VALID, REASON_VALID_NO_TS)
