"""Parsing, cleaning and time edge cases (FIXTURES.md section 3)."""

import math

import pytest
from pyspark.sql import functions as F

from tideline.constants import BOOKING_FIELD
from tideline.functions.cleaning import clean_byte_literal, to_double
from tideline.functions.timefmt import micros_to_text
from tideline.operators.flatten import flatten_changes


def _wire(spark, values):
    rows = [(None if v is None else v.encode(),) for v in values]
    return spark.createDataFrame(rows, "value binary")


@pytest.mark.parametrize("value", [None, "", "{bad", '[{"id":7}]', "5", "null", "{}"])
def test_unusable_messages_give_one_all_null_row(spark, value):
    out = flatten_changes(_wire(spark, [value]), processed_at=False).collect()
    assert len(out) == 1
    assert all(v is None for v in out[0])


def test_field_type_mismatch_nulls_only_that_field(spark):
    out = flatten_changes(_wire(spark, ['{"id":"9","__op":"u"}', '{"id":1.5,"__op":"c"}',
                                        '{"id":3,"zzz":1,"__op":"c"}']),
                          processed_at=False).collect()
    assert [(r.id, r.op) for r in out] == [(None, "u"), (None, "c"), (3, "c")]


@pytest.mark.parametrize("raw,cleaned,number", [
    ("b'1138.0'", "1138.0", 1138.0),
    ('"12.5"', "12.5", 12.5),
    ("b'\"7\"'", "7", 7.0),
    ("\"b'7'\"", "b'7'", None),
    ("b' 7 '", " 7 ", 7.0),
    ("NULL", "NULL", None),
    ("b'Infinity'", "Infinity", math.inf),
    ("12d", "12d", 12.0),
])
def test_byte_literal_cleaning(spark, raw, cleaned, number):
    df = spark.createDataFrame([(raw,)], "x string")
    r = df.select(clean_byte_literal(F.col("x")).alias("c"),
                  to_double(clean_byte_literal(F.col("x"))).alias("d")).first()
    assert r.c == cleaned
    assert r.d == number


def test_nan_text_becomes_nan(spark):
    r = spark.createDataFrame([("b'nan'",)], "x string") \
        .select(to_double(clean_byte_literal(F.col("x"))).alias("d")).first()
    assert math.isnan(r.d)


def test_json_number_in_text_field_keeps_its_text(spark):
    msg = '{"id":1,"%s":1138.5}' % BOOKING_FIELD
    r = flatten_changes(_wire(spark, [msg]), processed_at=False).first()
    assert r.booking_value == 1138.5


@pytest.mark.parametrize("micros,text", [
    (1700000000999999, "2023-11-14 22:13:20"),
    (-1500000, "1969-12-31 23:59:59"),
    (-500000, "1970-01-01 00:00:00"),
    (None, None),
])
def test_micros_to_text_truncates_toward_zero(spark, micros, text):
    df = spark.createDataFrame([(micros,)], "m long")
    assert df.select(micros_to_text(F.col("m")).alias("t")).first().t == text


def test_plain_cast_would_fail_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("NULL",)], "x string")
    with pytest.raises(Exception):
        df.select(F.col("x").cast("double")).collect()
