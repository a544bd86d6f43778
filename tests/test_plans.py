"""Plans: what is pushed down, what is bounded, and that identifiers of two signals never meet."""

import re

from gridloom.operators import completeness
from gridloom.plans import analysis, scans
from gridloom.sources import sinks
from gridloom.sources.readers import load_window, read_unified

from .conftest import DATA


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_window_prunes_partitions_rows_and_columns(spark, tmp_path):
    sinks.write_partitioned(scans.unified(spark, DATA), str(tmp_path / "u"))
    df = load_window(read_unified(spark, str(tmp_path / "u")), "dispatch", "2024-01-10 00:00:00", "2024-01-11 00:00:00", ["timestamp", "value_mw"])
    text = plan(df)
    assert re.search(r"PartitionFilters: \[.*source#\d+ = dispatch", text)
    assert "GreaterThanOrEqual(timestamp" in text and "LessThan(timestamp" in text
    assert "ReadSchema: struct<timestamp:timestamp_ntz,value_mw:double>" in text
    assert df.count() == scans.unified(spark, DATA).where("source = 'dispatch' AND timestamp >= '2024-01-10' AND timestamp < '2024-01-11'").count()


def test_top_k_is_a_heap(spark):
    assert "TakeOrderedAndProject" in plan(analysis.t02_top_ramps(spark, DATA))


def test_top_per_signal_is_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(analysis.t03_top_ramps_per_signal(spark, DATA))


def test_no_python_on_executors(spark):
    from gridloom.plans.catalogue import QUERIES

    for name in ("a03_daily_load_shape", "w04_longest_gap", "j01_three_way_outer", "a14_quantiles", "x_ts_parse"):
        assert not re.search("Python|Pandas|Arrow", plan(QUERIES[name](spark, DATA))), name


def test_signals_are_joined_on_time_alone(spark):
    for line in plan(scans.j01_three_way_outer(spark, DATA)).split("\n"):
        if "Join" in line:
            assert "generator_id" not in line


def test_axis_is_half_open(spark):
    assert completeness.axis(spark, "2024-01-01 00:00:00", "2024-02-01 00:00:00").count() == 8928
    assert completeness.axis(spark, "2024-01-01 06:00:00", "2024-01-01 06:10:00").count() == 2
