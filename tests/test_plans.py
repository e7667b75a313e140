"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries

PYTHON = re.compile(r"(ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|FlatMapGroupsInArrow|FlatMapCoGroups|MapInPandas|MapInArrow|PythonMap|PythonUDF)")
EXPRESSION_ONLY = [
    "tumbling_mean_by_split", "tumbling_features", "describe_numeric", "pairwise_corr", "histogram",
    "rolling_band_flag", "cusum_two_sided", "cusum_two_sided_chunked", "ewma_recursive", "gap_fill", "thin_series",
    "sample_per_class", "classification_report", "confusion_matrix", "parse_line", "log_volume", "log_patterns",
    "detected_fields", "outlier_series", "minmax_scale", "nearest_centroid", "zscore_flag", "ksigma_flag",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", EXPRESSION_ONLY)
def test_no_python_and_no_cross_join(spark, data, name):
    text = plan(queries()[name](spark, data))
    assert not PYTHON.search(text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["rolling_stats_chunked", "cusum_two_sided_chunked", "thin_series_chunked", "backfill_batches"])
def test_no_window_in_one_partition(spark, name):
    """Every window is fed by a hash exchange on series and chunk."""
    text = plan(queries()[name](spark, "/root/testdata/sf0.01"))
    assert "__chunk" in text
    windows = re.findall(r"Window \[.*?\], \[(.*?)\]", text)
    assert windows and all(w.strip() for w in windows)


@pytest.mark.parametrize(
    "name,pushed",
    [
        ("time_range", "GreaterThanOrEqual(ts,2024-01-08"),
        ("dashboard_range", "GreaterThanOrEqual(ts,2024-01-08"),
        ("table_query", "EqualTo(event_type,click)"),
        ("line_contains_exact", "StringContains(text,. )"),
    ],
)
def test_pushdown(spark, data, name, pushed):
    assert pushed in plan(queries()[name](spark, data))


def test_pruning(spark, data):
    text = plan(queries()["series_stats"](spark, data))
    assert "ReadSchema: struct<event_type:string,value:double>" in text


def test_partial_aggregation(spark, data):
    assert "partial_avg" in plan(queries()["tumbling_features"](spark, data))


def test_one_range_scan_reaches_the_files(spark, data):
    text = plan(queries()["log_volume"](spark, data))
    assert text.count("Exchange hashpartitioning") == 1


def test_unused_json_fields_are_not_parsed(spark, data):
    """from_json is asked only for the fields the query uses."""
    from sensorloom.functions.parsing import parse_message
    from sensorloom.plans.ingest import MESSAGE, messages

    text = plan(parse_message(messages(spark, data), MESSAGE).agg(F.sum("value")))
    assert "from_json(StructField(value,DoubleType,true)" in text
