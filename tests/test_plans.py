"""What the physical plans must look like."""

import re

import pytest
from conftest import SF_SMALL, plan_of

from pyspark.sql import functions as F
from tidemark.operators import rolling_stats, with_bands, with_signals, with_zscore
from tidemark.plans import job, reports
from tidemark.sinks import RunStamp, bands_output, zscore_output
from tidemark.sources.views import hourly_bars, tick_series

STAMP = RunStamp()


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


@pytest.fixture(scope="module")
def stored_bars(spark, events, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bars") / "bars.parquet")
    hourly_bars(events).write.parquet(path)
    return spark.read.parquet(path)


def operators(df):
    """Operator names of the plan, from the tree at its top."""
    tree = plan_of(df).split("\n\n\n")[0]
    return re.findall(r"[+:\-\s*]*\s*(\w+)(?: \w+)* +\(\d+\)", tree)


def test_one_exchange_one_sort_one_window(events):
    ops = operators(with_signals(rolling_stats(tick_series(events), 20)))
    assert [ops.count(o) for o in ("Exchange", "Sort", "Window")] == [1, 1, 1]
    assert not [o for o in ops if "Python" in o or "Pandas" in o]


def test_only_needed_columns_are_read(events):
    plan = plan_of(rolling_stats(tick_series(events), 20))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_symbol_filter_goes_below_the_window_and_time_filter_does_not(stored_bars):
    stats = rolling_stats(stored_bars, 20)
    assert "EqualTo(Symbol,CLICK)" in plan_of(stats.where("Symbol = 'CLICK'"))
    late = plan_of(stats.where("BarDateTime > timestamp_ntz'2024-01-10'"))
    assert "GreaterThan(BarDateTime" not in late


def test_top_anomalies_need_no_global_sort(events):
    scores = zscore_output(with_zscore(rolling_stats(tick_series(events), 20)), 20, 2.0, STAMP)
    ops = operators(reports.top_anomalies(scores))
    assert "TakeOrderedAndProject" in ops
    assert [ops.count(o) for o in ("Exchange", "Sort")] == [1, 1]


def test_previews_see_fifty_rows_only(events):
    ops = operators(job.bands_preview(tick_series(events), 20, 2.0))
    assert "Exchange" not in ops and "TakeOrderedAndProject" in ops
    assert ops.index("Window") < ops.index("TakeOrderedAndProject")  # parents come first


def test_summaries_of_fresh_results_reuse_the_partitioning(events):
    stats = rolling_stats(tick_series(events), 20)
    bands = bands_output(with_bands(stats, 2.0), 20, 2.0, STAMP)
    ops = operators(reports.bollinger_summary(bands))
    # Range of the sort, summary rows, source to window: none between window and aggregate.
    assert ops.count("Exchange") == 3
    assert ops[1:5] == ["Sort", "Exchange", "Exchange", "HashAggregate"]
    assert ops.index("Exchange", ops.index("HashAggregate")) > ops.index("Window")


def test_report_of_one_frame_scans_and_sorts_it_once(stored_bars):
    stats = rolling_stats(stored_bars, 20)
    bands = bands_output(with_bands(stats, 2.0), 20, 2.0, STAMP)
    scores = zscore_output(with_zscore(stats, 2.0), 20, 2.0, STAMP)
    report = reports.per_symbol_report(reports.price_groups(bands), reports.anomaly_groups(scores))
    report.collect()
    final = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
    assert "CartesianProduct" not in final and "BroadcastNestedLoopJoin" not in final


def test_totals_use_no_cross_join(stored_bars):
    stored = with_signals(rolling_stats(stored_bars, 20))
    plan = plan_of(reports.overall_totals(stored, stored))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_pieces_need_one_window_and_no_sort_merge_join(events):
    from tidemark.operators import plan_layout

    ticks = tick_series(events)
    layout = plan_layout(ticks, rows_per_task=20)
    ops = operators(rolling_stats(ticks, 20, layout=layout))
    assert "SortMergeJoin" not in ops and "CartesianProduct" not in ops
    assert not [o for o in ops if "Python" in o or "Pandas" in o]
