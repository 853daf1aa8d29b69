"""Windows merged from blocks must give what sliding frames give."""

import math
from datetime import timedelta
from decimal import Decimal

import pytest
from conftest import SCHEMA, SF_SMALL, T0, plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from tidemark.operators import balanced_rolling_stats, plan_layout, rolling_stats
from tidemark.operators import rolling as rolling_module
from tidemark.series import SeriesSpec
from tidemark.sources.views import hourly_bars

NAN, INF = float("nan"), float("inf")


def close(a, b, scale):
    if a is None or b is None or isinstance(a, (Decimal, bool)):
        return a == b
    if math.isnan(a) or math.isnan(b) or math.isinf(a) or math.isinf(b):
        return repr(a) == repr(b)
    return abs(a - b) <= 1e-9 * max(1.0, scale, abs(a))


def same(left, right, scale=1.0):
    assert left.columns == right.columns
    assert [f.dataType for f in left.schema] == [f.dataType for f in right.schema]
    key = [c for c in left.columns if c not in ("MovingAvg", "RollingStd")]
    rows = [sorted((tuple(r) for r in df.select(*key, "MovingAvg", "RollingStd").collect()), key=repr) for df in (left, right)]
    assert len(rows[0]) == len(rows[1])
    for a, b in zip(*rows):
        assert repr(a[: len(key)]) == repr(b[: len(key)])
        assert all(close(x, y, scale) for x, y in zip(a[len(key) :], b[len(key) :])), (a, b)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 20])
def test_edge_series(make_bars, n):
    bars = make_bars(
        FLAT=[0.1] * 9,
        NULLS=[None, 1.0, None, None, 3.0, 4.0, None, None, None, None, 2.0, 2.0],
        NAN=[1.0, NAN, 2.0, 3.0, 4.0, 4.0, 4.0, NAN, NAN, NAN, NAN, NAN, 7.0],
        INF=[INF, INF, 1.0, 2.0, 2.0, 2.0, -INF, 5.0, 5.0, 6.0, 6.0],
        GOLD=[1.0, 2.0, 3.0, 4.0, 10.0],
        ONE=[7.5],
        SPIKE=[1e12] + [1.0, 1.1, 1.2, 1.1] * 4 + [0.3] * 10,
        NOTHING=[None] * 7,
    )
    same(rolling_stats(bars, n, wide=True), rolling_stats(bars, n, wide=False))


def test_flat_windows_have_exactly_no_spread(make_bars):
    bars = make_bars(FLAT=[3.3, 0.1, 0.1, 0.1, 0.1, 0.1, 0.7, 0.7, 0.7])
    out = rolling_stats(bars, 3, wide=True).where("RowNum IN (4, 5, 6, 9)")
    assert [r.RollingStd for r in out.collect()] == [0.0] * 4


def test_large_values_keep_their_spread(make_bars):
    values = [1e14 + (i * 7919 % 13) / 8 for i in range(400)]
    bars = make_bars(A=values)
    out = {r.RowNum: r for r in rolling_stats(bars, 100, wide=True).collect()}
    for row in (100, 137, 200, 399):
        window = [v - 1e14 for v in values[row - 100 : row]]
        mean = sum(window) / 100
        std = math.sqrt(sum((v - mean) ** 2 for v in window) / 99)
        assert abs(out[row].RollingStd - std) < 1e-6


def test_decimals_and_other_types(spark, make_bars):
    bars = make_bars(A=[1.25, None, 2.5, 2.5, 2.5, 9.75, -3.0, 0.0], B=[4.0, 4.0, 4.0, 4.0])
    for kind in ("decimal(18,4)", "decimal(38,10)", "float", "int"):
        typed = bars.withColumn("ClosePrice", F.col("ClosePrice").cast(kind))
        same(rolling_stats(typed, 3, wide=True), rolling_stats(typed, 3, wide=False))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 2), st.sampled_from([None, 0.1, 0.1, 5.0, -2.5, 1e6, NAN, INF])), max_size=60),
    st.integers(1, 12),
    st.integers(1, 9),
)
def test_cut_and_whole_series(spark, rows, n, piece):
    data = [(f"S{k}", T0 + timedelta(minutes=i), v) for i, (k, v) in enumerate(rows)]
    bars = spark.createDataFrame(data, SCHEMA)
    frames = rolling_stats(bars, n, wide=False)
    same(rolling_stats(bars, n, wide=True), frames, 1e6)
    same(balanced_rolling_stats(bars, n, rows_per_task=piece, wide=True), frames, 1e6)


def test_several_keys_and_their_own_columns(spark):
    rows = [("x", i % 2, i, float(i * i % 7), i) for i in range(50)]
    df = spark.createDataFrame(rows, "venue string, desk int, ts int, px double, _block int")
    spec = SeriesSpec(keys=("venue", "desk"), order="ts", value="px")
    df = df.withColumnRenamed("_block", "extra")
    same(rolling_stats(df, 4, spec, wide=True), rolling_stats(df, 4, spec, wide=False))
    layout = plan_layout(df, spec, rows_per_task=6)
    same(rolling_stats(df, 4, spec, layout, wide=True), rolling_stats(df, 4, spec, wide=False))


def test_wide_windows_are_merged_by_default_and_exchange_once(spark):
    bars = hourly_bars(spark.read.parquet(f"{SF_SMALL}/events.parquet")).select("Symbol", "BarDateTime", "ClosePrice")
    bars = bars.persist()
    try:
        wide, narrow = rolling_stats(bars, rolling_module.WIDE_WINDOW), rolling_stats(bars, 20)
        trees = [plan_of(df).split("\n\n\n")[0].split("InMemoryTableScan")[0] for df in (wide, narrow)]
        assert [t.count("Exchange (") for t in trees] == [1, 1]
        assert [t.count("Sort (") for t in trees] == [3, 1]
        assert [t.count("Window (") for t in trees] == [6, 1]
        with pytest.raises(ValueError, match="window size"):
            rolling_stats(bars, 0, wide=True)
    finally:
        bars.unpersist()
