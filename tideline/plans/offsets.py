"""Queries over topic offsets: end offsets, offset-range reads, lag."""

from __future__ import annotations

import json

from ..constants import CAPTURE_TOPIC, PRODUCER_TOPIC
from ..operators.flatten import decode_value
from ..operators.offsets import (consumer_lag, footer_offsets, offset_range, read_commits, topic_offsets,
                                 write_by_partition)
from ..sources.topic import TopicSource
from ..streaming.jobs import run_available, start_committing_stream
from .fixtures import load, mixed_wire
from .registry import register
from .sqlparts import EVENTS_CTE
from .staging import fresh, staged, staged_wire

START_SPEC = json.dumps({CAPTURE_TOPIC: {"0": 100, "1": -2, "2": -1}})
END_SPEC = json.dumps({PRODUCER_TOPIC: {"0": 50}})
COMMITTED_SPEC = json.dumps({CAPTURE_TOPIC: {"0": 120, "1": 400}, PRODUCER_TOPIC: {"2": 7}})

_ENDS = f"""
ends AS (SELECT mixed_topic AS topic, part AS partition, min(off6) AS start_offset,
                max(off6) + 1 AS end_offset, count(*) AS messages FROM ev GROUP BY ALL)"""


def _mixed(spark, sf_dir):
    return staged_wire(spark, sf_dir, "mixed_wire", lambda: mixed_wire(load(spark, sf_dir, "events")))


def _by_partition(spark, sf_dir) -> str:
    return staged(spark, sf_dir, "mixed_wire_by_partition", lambda: mixed_wire(load(spark, sf_dir, "events")),
                  write=write_by_partition)


@register("topic_offsets", f"""
WITH {EVENTS_CTE}, {_ENDS}
SELECT topic, partition, start_offset, end_offset, messages,
       count(*) OVER (PARTITION BY topic) AS partitions,
       bool_or(end_offset > 0) OVER (PARTITION BY topic) AS has_messages
FROM ends
""")
def topic_offsets_q(spark, sf_dir):
    """Per topic-partition start/end offsets and message counts; per topic
    the partition count and whether it holds messages; from file statistics."""
    return topic_offsets(None, footer_offsets(spark, _by_partition(spark, sf_dir)))


@register("offset_range_scan", f"""
WITH {EVENTS_CTE}
SELECT mixed_topic AS topic, part AS partition, off6 AS "offset", '{{"id":' || i || '}}' AS key_text
FROM ev
WHERE (i % 2 = 0 AND ((part = 0 AND off6 >= 100) OR part = 1))
   OR (i % 2 = 1 AND (part <> 0 OR off6 < 50))
""")
def offset_range_scan(spark, sf_dir):
    """Bounded read with per-partition start offsets (explicit, earliest,
    latest, and omitted -> earliest) and end offsets."""
    rows = offset_range(_mixed(spark, sf_dir), START_SPEC, END_SPEC)
    return rows.select("topic", "partition", "offset", decode_value("key").alias("key_text"))


@register("consumer_lag", f"""
WITH {EVENTS_CTE}, {_ENDS},
com(topic, partition, committed_offset) AS (
  VALUES ('{CAPTURE_TOPIC}', 0, 120::BIGINT), ('{CAPTURE_TOPIC}', 1, 400::BIGINT),
         ('{PRODUCER_TOPIC}', 2, 7::BIGINT))
SELECT e.topic, e.partition, e.end_offset, c.committed_offset,
       e.end_offset - coalesce(c.committed_offset, e.start_offset) AS lag
FROM ends e LEFT JOIN com c ON e.topic = c.topic AND e.partition = c.partition
""")
def consumer_lag_q(spark, sf_dir):
    """Lag of a consumer group per topic-partition from its committed
    offsets (three commits, the other partitions never committed)."""
    return consumer_lag(None, COMMITTED_SPEC, footer_offsets(spark, _by_partition(spark, sf_dir)))


_SEEN = 40                                             # offsets per topic-partition that the consumer got to read


@register("stream_consumer_lag", f"""
WITH {EVENTS_CTE}, {_ENDS}
SELECT topic, partition, end_offset, least(end_offset, {_SEEN}) AS committed_offset,
       end_offset - least(end_offset, {_SEEN}) AS lag FROM ends
""")
def stream_consumer_lag(spark, sf_dir):
    """Lag of a consumer that was stopped before the topic's second half landed,
    from the offsets its batches have committed."""
    wire = _mixed(spark, sf_dir)
    root, table, commits = (fresh(spark, f"lag_{n}") for n in ("wire", "table", "commits"))
    wire.where(f"offset < {_SEEN}").write.parquet(root)
    source = TopicSource(wire_path=root, starting_offsets="earliest", max_per_trigger=3)
    run_available(start_committing_stream(spark, source, table, commits, trigger="availableNow"))
    wire.where(f"offset >= {_SEEN}").write.mode("append").parquet(root)
    return consumer_lag(source.read(spark), read_commits(spark, commits))
