"""Physical-plan properties of the registered queries at scale-relevant
points: parse once, no Python UDFs, no single-partition windows, filters and
column pruning reaching the scan."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tideline.plans import registry

SKIP_SIDE_EFFECTS = {"stream_cdc_flatten", "stream_append", "stream_restart", "asof_batch",
                     "stream_validate", "stream_capture", "stream_consumer_lag", "stream_latest"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_parses_each_message_once(spark):
    plan = _plan(E.entry(spark))
    assert plan.count("from_json(") == 1


def test_capture_chain_parses_envelope_and_record_once_each(spark):
    plan = _plan(E.queries()["capture_flatten"](spark, SF_SMALL))
    assert plan.count("from_json(") == 2


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - SKIP_SIDE_EFFECTS))
def test_no_python_udf_and_no_single_partition_window(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:   # only partial results into a final aggregate
            assert "Aggregate" in lines[i - 1], lines[i - 1]
        if re.search(r"\bWindow \[", line):
            assert not re.search(r"\], \[\](,|\s*$)", line), line   # a window needs a partition key


def test_time_filter_reaches_the_scan(spark):
    plan = E.queries()["time_range_lookup"](spark, SF_SMALL)._jdf.queryExecution() \
        .executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*created_at", plan)


def test_topic_offsets_come_from_file_statistics(spark):
    df = E.queries()["topic_offsets"](spark, SF_SMALL)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    assert re.search(r"PushedAggregation: \[MIN\(offset\), MAX\(offset\), COUNT\(", plan)
    assert re.search(r"PushedGroupBy: \[[^\]]*topic[^\]]*partition", plan)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"      # the caller's session is left alone


def test_offsets_read_only_three_columns(spark):
    from tideline.plans.streams import _capture_source
    from tideline.operators.offsets import end_offsets
    src = _capture_source(spark, SF_SMALL)
    plan = _plan(end_offsets(src.read(spark)))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "value" not in schema and "key" not in schema
