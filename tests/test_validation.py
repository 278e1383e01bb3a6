"""Validation reasons (falsy -> empty, non-object, timestamp keys)."""

import pytest

from tideline.constants import (REASON_EMPTY, REASON_ERROR, REASON_NOT_OBJECT, REASON_VALID,
                                REASON_VALID_NO_TS)
from tideline.operators.validate import (match_messages, message_previews, validate_messages,
                                         validation_summary)

CASES = [
    ('{"a":1}] x', "JSON validation error"), ("1],[2", "JSON validation error"),
    ("1,2", "JSON validation error"),
    (None, REASON_EMPTY), ("", REASON_EMPTY), ("{}", REASON_EMPTY), ("[]", REASON_EMPTY),
    ("0", REASON_EMPTY), ('""', REASON_EMPTY), ("false", REASON_EMPTY), ("null", REASON_EMPTY),
    ("0.0", REASON_EMPTY), ("-0", REASON_EMPTY), ("0e5", REASON_EMPTY),
    ("[1]", REASON_NOT_OBJECT), ("[null]", REASON_NOT_OBJECT), ("5", REASON_NOT_OBJECT),
    ('"a"', REASON_NOT_OBJECT), ('"0"', REASON_NOT_OBJECT), ("true", REASON_NOT_OBJECT),
    ('{"timestamp":1}', REASON_VALID), ('{"created_at":null}', REASON_VALID),
    ('{"op":"c"}', REASON_VALID), (' {"op":1} ', REASON_VALID),
    ('{"__op":"c"}', REASON_VALID_NO_TS), ('{"x":{"op":1}}', REASON_VALID_NO_TS),
    ("{bad", REASON_ERROR), ("   ", REASON_ERROR),
]


@pytest.fixture(scope="module")
def validated(spark):
    rows = [("t", 0, i, None if v is None else v.encode()) for i, (v, _) in enumerate(CASES)]
    wire = spark.createDataFrame(rows, "topic string, partition int, offset long, value binary")
    return {r.offset: r for r in validate_messages(wire).collect()}, wire


@pytest.mark.parametrize("idx", range(len(CASES)))
def test_reason(validated, idx):
    got = validated[0][idx]
    text, reason = CASES[idx]
    assert got.reason == reason, text
    assert got.valid == (reason in (REASON_VALID, REASON_VALID_NO_TS))


def test_summary_counts_every_message(validated):
    total = sum(r.messages for r in validation_summary(validate_messages(validated[1])).collect())
    assert total == len(CASES)


def test_preview_truncates_valid_messages_only(spark):
    long_msg = '{"created_at":1,"pad":"' + "x" * 300 + '"}'
    wire = spark.createDataFrame([("t", 0, 0, long_msg.encode()), ("t", 0, 1, b"[1]")],
                                 "topic string, partition int, offset long, value binary")
    rows = {r.offset: r.preview for r in message_previews(wire).collect()}
    assert rows[0] == long_msg[:200] + "..."
    assert rows[1] is None


def test_match_on_action(spark):
    wire = spark.createDataFrame([("t", 0, 0, b'{"id":999,"action":"test_message"}'),
                                  ("t", 0, 1, b'{"id":1,"action":"other"}'),
                                  ("t", 0, 2, b"[1]")],
                                 "topic string, partition int, offset long, value binary")
    assert [(r.offset, r.id) for r in match_messages(wire).collect()] == [(0, 999)]
