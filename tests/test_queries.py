"""Every registered query against its DuckDB oracle (sf0.001), the smoke
entry, and stream = batch."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_harness import compare, duck

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    from tideline.plans import registry
    assert set(registry.queries()) == set(registry.oracles())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, E.queries()[name], ORACLES[name], con)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "op", "created_at_ts", "updated_at_ts", "booking_value", "ride_distance"]
    assert df.count() == 1000


def test_stream_equals_batch(spark):
    q = E.queries()
    batch = q["cdc_flatten"](spark, SF_SMALL)
    stream = q["stream_cdc_flatten"](spark, SF_SMALL)
    assert batch.exceptAll(stream).count() == 0 and stream.exceptAll(batch).count() == 0


def test_stream_append_has_processing_time(spark, tmp_path):
    from tideline.plans.streams import _capture_source
    from tideline.streaming.jobs import run_available, start_change_stream
    out = str(tmp_path / "lake")
    run_available(start_change_stream(spark, _capture_source(spark, SF_SMALL), out,
                                      fmt="parquet", trigger="availableNow"))
    table = spark.read.parquet(out)
    assert table.where(F.col("processed_at").isNull()).count() == 0
    assert table.count() == 1000
