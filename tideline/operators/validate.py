"""Message validation (row level), its counts, previews and value matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import PREVIEW_CHARS, TEST_ACTION
from ..functions.jsonkinds import add_validation, is_valid_reason
from .flatten import decode_value

KEYS = ("topic", "partition", "offset")


def _validated(wire: DataFrame, keep) -> DataFrame:
    return add_validation(wire.select(*keep, decode_value("value").alias("_text")), "_text")


def validate_messages(wire: DataFrame, keep=KEYS) -> DataFrame:
    """One row per message: ``valid`` and ``reason``.  Malformed JSON is a
    row with the error reason; the stream goes on."""
    return _validated(wire, keep).select(*keep, is_valid_reason(F.col("reason")).alias("valid"),
                                         "reason")


def validation_summary(validated: DataFrame) -> DataFrame:
    """Messages per topic, validity and reason (partial aggregation first:
    the shuffle carries one row per group and map task)."""
    return (validated.groupBy("topic", "valid", "reason")
            .agg(F.count(F.lit(1)).alias("messages")))


def preview(text: Column, limit: int = PREVIEW_CHARS) -> Column:
    """First ``limit`` characters and ``...`` when longer."""
    return (F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("...")))
            .otherwise(text))


def message_previews(wire: DataFrame, keep=KEYS) -> DataFrame:
    """Preview of each valid message's text (NULL for invalid ones)."""
    v = _validated(wire, keep)
    return v.select(*keep, F.when(is_valid_reason(F.col("reason")), preview(F.col("_text")))
                    .alias("preview"))


def match_messages(wire: DataFrame, path: str = "$.action", expected: str = TEST_ACTION,
                   keep=KEYS) -> DataFrame:
    """Messages whose JSON field at ``path`` equals ``expected``."""
    text = decode_value("value")
    return (wire.where(F.get_json_object(text, path) == expected)
            .select(*keep, F.get_json_object(text, "$.id").cast("long").alias("id")))
