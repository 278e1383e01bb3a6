"""Queries over the two business topics: decoding, validation, counts,
previews, value matching and multi-topic subscription."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import BUSINESS_TOPICS, CAPTURE_TOPIC
from ..operators.flatten import decode_value
from ..operators.validate import (match_messages, message_previews, validate_messages,
                                  validation_summary)
from ..sources.topic import TopicSource
from .changes import captured
from .fixtures import load, mixed_wire
from .registry import register
from .sqlparts import CAPTURE_TEXT, EVENTS_CTE, MIXED_REASON, MIXED_TEXT, VALID_OF
from .staging import staged, staged_wire

_KEYS = ("topic", "partition", "offset")


def _mixed(spark, sf_dir):
    return staged_wire(spark, sf_dir, "mixed_wire", lambda: mixed_wire(load(spark, sf_dir, "events")))


@register("wire_decode", f"""
WITH {EVENTS_CTE}
SELECT '{CAPTURE_TOPIC}' AS topic, part AS partition, off3 AS "offset", {CAPTURE_TEXT} AS json_str FROM ev
""")
def wire_decode(spark, sf_dir):
    """Message bytes -> UTF-8 text (tombstones stay NULL)."""
    wire = captured(spark, sf_dir)
    return wire.select(*_KEYS, decode_value("value").alias("json_str"))


@register("validate_messages", f"""
WITH {EVENTS_CTE}, r AS (SELECT mixed_topic AS topic, part AS partition, off6 AS "offset",
                                {MIXED_REASON} AS reason FROM ev)
SELECT topic, partition, "offset", {VALID_OF.format('reason')} AS valid, reason FROM r
""")
def validate_messages_q(spark, sf_dir):
    """Each message on both topics judged valid/invalid with a reason."""
    return validate_messages(_mixed(spark, sf_dir))


@register("stream_validate", f"""
WITH {EVENTS_CTE}, r AS (SELECT mixed_topic AS topic, part AS partition, off6 AS "offset",
                                {MIXED_REASON} AS reason FROM ev)
SELECT topic, partition, "offset", {VALID_OF.format('reason')} AS valid, reason FROM r
""")
def stream_validate(spark, sf_dir):
    """The validating consumer subscribed to both business topics as a
    stream (availableNow), appended to a table and read back."""
    from ..streaming.jobs import run_available, start_validation_stream
    from .staging import fresh
    path = staged(spark, sf_dir, "mixed_wire", lambda: mixed_wire(load(spark, sf_dir, "events")))
    src = TopicSource(topics=BUSINESS_TOPICS, wire_path=path, starting_offsets="earliest")
    out = fresh(spark, "stream_validate")
    run_available(start_validation_stream(spark, src, out, trigger="availableNow"))
    return spark.read.parquet(out)


@register("validation_summary", f"""
WITH {EVENTS_CTE}, r AS (SELECT mixed_topic AS topic, {MIXED_REASON} AS reason FROM ev)
SELECT topic, {VALID_OF.format('reason')} AS valid, reason, count(*) AS messages
FROM r GROUP BY ALL
""")
def validation_summary_q(spark, sf_dir):
    """Messages counted per topic, validity and reason."""
    return validation_summary(validate_messages(_mixed(spark, sf_dir)))


@register("message_preview", f"""
WITH {EVENTS_CTE}, r AS (SELECT mixed_topic AS topic, part AS partition, off6 AS "offset",
                                {MIXED_REASON} AS reason, {MIXED_TEXT} AS t FROM ev)
SELECT topic, partition, "offset",
       CASE WHEN {VALID_OF.format('reason')} THEN
            CASE WHEN length(t) > 200 THEN substr(t, 1, 200) || '...' ELSE t END END AS preview
FROM r
""")
def message_preview(spark, sf_dir):
    """First 200 characters (+ '...') of every valid message."""
    return message_previews(_mixed(spark, sf_dir))


@register("message_match", f"""
WITH {EVENTS_CTE}
SELECT mixed_topic AS topic, part AS partition, off6 AS "offset", i AS id
FROM ev WHERE NOT tomb AND i % 2 = 1 AND kind = 0
""")
def message_match(spark, sf_dir):
    """Messages whose ``action`` is the test action."""
    return match_messages(_mixed(spark, sf_dir))


@register("topics_union", f"""
WITH {EVENTS_CTE}
SELECT mixed_topic AS topic, part AS partition, off6 AS "offset", {MIXED_TEXT} AS json_str FROM ev
""")
def topics_union(spark, sf_dir):
    """Both business topics (plus one that does not exist) read as one
    bounded stream from a staged wire table."""
    path = staged(spark, sf_dir, "mixed_wire", lambda: mixed_wire(load(spark, sf_dir, "events")))
    src = TopicSource(topics=BUSINESS_TOPICS + ("business_postgres.public.absent",),
                      wire_path=path, starting_offsets="earliest")
    return src.read(spark).select(*_KEYS, decode_value("value").alias("json_str"))
