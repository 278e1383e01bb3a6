"""Column names, fills, type inference rules (FIXTURES.md section 3), typed load."""

import pytest

from tideline.operators.ids import surrogate_ids
from tideline.operators.profile import string_widths
from tideline.operators.shape import (ColumnType, add_audit_columns, cast_failures, fill_missing, infer_types,
                                      normalize_columns, typed_load)
from tideline.sinks import replace_table, write_record_sets
from tideline.sources.csvfiles import read_csv_dataset
from tideline.functions.naming import normalize_name, normalize_names


def _col(spark, values):
    return spark.createDataFrame([(v,) for v in values], "c string")


@pytest.mark.parametrize("values,expected", [
    (["1", "2", "3"], "INTEGER"),
    ([" 1", "2 "], "INTEGER"),
    (["5000000000"], "INTEGER"),
    (["18446744073709551615"], "INTEGER"),
    (["99999999999999999999999"], "VARCHAR(46)"),
    (["1.5", None, "NA"], "DECIMAL(15,4)"),
    (["1", None], "DECIMAL(15,4)"),
    (["+1", "1e3"], "DECIMAL(15,4)"),
    (["inf", "1"], "DECIMAL(15,4)"),
    (["NULL", "NULL", "nan"], "DECIMAL(15,4)"),
    (["True", "False", "True"], "BOOLEAN"),
    (["true", "FALSE"], "BOOLEAN"),
    (["True", None], "VARCHAR(8)"),
    (["True", "false", "yes"], "VARCHAR(10)"),
    (["x", None, "y"], "VARCHAR(6)"),
    (["F", None], "VARCHAR(6)"),
    (["2024-01-01 00:00:00"], "VARCHAR(38)"),
    (["a" * 600], "VARCHAR(1000)"),
    ([], "VARCHAR(255)"),
])
def test_inference_rules(spark, values, expected):
    assert infer_types(_col(spark, values))[0].sql_type == expected


def test_spark_types_follow_the_range(spark):
    assert infer_types(_col(spark, ["1", "2"]))[0].spark_type == "int"
    assert infer_types(_col(spark, ["5000000000"]))[0].spark_type == "bigint"
    assert infer_types(_col(spark, ["18446744073709551615"]))[0].spark_type == "decimal(20,0)"
    assert infer_types(_col(spark, ["-1", "18446744073709551615"]))[0].sql_type.startswith("VARCHAR")


def test_names():
    assert normalize_name("Account Balance (USD)") == "Account_Balance_USD"
    assert normalize_name("Customer-Name", lowercase=True) == "customer_name"
    assert normalize_name("ncr_ride_bookings.csv/booking+value") == "ncr_ride_bookings.csv/booking+value"
    with pytest.raises(ValueError):
        normalize_names(["a b", "a-b"])


def test_fill_and_typed_load(spark):
    df = spark.createDataFrame([("1", "x", "1.5", "True"), ("2", None, "NA", "False")],
                               "`Key A` string, `Name (n)` string, `Val-1` string, Flag string")
    filled = fill_missing(normalize_columns(df)).collect()
    assert filled[1]["Name_n"] == "NULL" and filled[1]["Val_1"] == "NULL"
    typed = typed_load(df)
    assert [f.dataType.simpleString() for f in typed.schema.fields] == \
        ["int", "string", "decimal(15,4)", "boolean"]
    rows = typed.orderBy("Key_A").collect()
    assert rows[1]["Name_n"] == "NULL" and rows[1]["Val_1"] is None and rows[1]["Flag"] is False


def test_rejected_values_stop_the_load_or_are_counted(spark):
    df = spark.createDataFrame([("1.5", "True"), ("123456789012345.5", "yes"), ("inf", None)], "a string, b string")
    types = [ColumnType("a", "DECIMAL(15,4)", "decimal(15,4)", "float64"),
             ColumnType("b", "BOOLEAN", "boolean", "bool")]
    with pytest.raises(Exception, match="cannot hold"):
        typed_load(df, types).collect()
    assert [r.a is None for r in typed_load(df, types, rejects="null").collect()] == [False, True, True]
    assert [tuple(r) for r in cast_failures(df, types).collect()] == [("a", "DECIMAL(15,4)", 2), ("b", "BOOLEAN", 1)]


def test_reserved_names_raise(spark):
    with pytest.raises(ValueError):
        add_audit_columns(spark.createDataFrame([(1,)], "Created_At int"))
    with pytest.raises(ValueError):
        surrogate_ids(spark.createDataFrame([(1, 2)], "ID int, k int"), "unused", order_by=["k"])


def test_record_sets_skip_empty_ones(spark, tmp_path):
    rows = spark.createDataFrame([("x", None)], "`s/A (b)` string, c string")
    paths = write_record_sets({"My Set.csv": rows, "None.csv": rows.where("false")}, str(tmp_path))
    assert paths == {"My Set.csv": f"{tmp_path}/my_set.csv"}
    back = read_csv_dataset(spark, paths["My Set.csv"])
    assert back.columns == ["s/a_b", "c"] and [tuple(r) for r in back.collect()] == [("x", "NULL")]
    with pytest.raises(ValueError):
        write_record_sets({"None.csv": rows.where("false")}, str(tmp_path))


def test_second_load_replaces_the_first(spark, tmp_path):
    for n in (5, 3):
        path = replace_table(spark.range(n), str(tmp_path), "business_x")
    assert spark.read.parquet(path).count() == 3


def test_widths_of_a_file_without_text_columns(spark):
    assert string_widths(spark.range(3)).collect() == []


def test_a_failed_swap_leaves_the_table(spark, tmp_path):
    from pyspark.sql import functions as F
    from tideline.sinks import swap_table
    swap_table(spark.range(5), str(tmp_path), "swap_test")
    with pytest.raises(Exception):
        swap_table(spark.range(9).select(F.raise_error(F.lit("no")).cast("int").alias("x")), str(tmp_path), "swap_test")
    assert spark.table("swap_test").columns == ["id"] and spark.table("swap_test").count() == 5
    spark.sql("DROP VIEW swap_test")
