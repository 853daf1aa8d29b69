"""Series computed by hand, and properties that hold for any series."""

import math

import pytest
from conftest import SF_SMALL, T0, by_row

from pyspark.sql import functions as F
from pyspark.sql import types as T
from tidemark.operators import (
    leading_rolling_stats,
    rolling_stats,
    with_bands,
    with_signals,
    with_zscore,
)
from tidemark.series import SeriesSpec
from tidemark.sources.views import tick_series

SIGNALS = (
    "MovingAvg",
    "RollingStd",
    "UpperBand",
    "LowerBand",
    "ZScore",
    "RowNum",
    "IsWarmup",
    "IsAnomaly",
)


def signals(df, n, k=2.0, threshold=2.0):
    return with_signals(rolling_stats(df, n), k, threshold)


def near(actual, expected):
    for got, want in zip(actual, expected, strict=True):
        if isinstance(want, float) and got is not None:
            assert got == pytest.approx(want, abs=1e-6)
        else:
            assert got == want


def test_golden_series(make_bars):
    rows = by_row(signals(make_bars(A=[1.0, 2.0, 3.0, 4.0, 10.0]), 3, 2.0, 1.1), *SIGNALS)
    near(rows[0], (1.0, None, None, None, None, 1, True, False))
    near(rows[1], (1.5, 0.707107, 2.914214, 0.085786, 0.707107, 2, True, False))
    near(rows[2], (2.0, 1.0, 4.0, 0.0, 1.0, 3, False, False))
    near(rows[3], (3.0, 1.0, 5.0, 1.0, 1.0, 4, False, False))
    near(rows[4], (5.666667, 3.785939, 13.238544, -1.905211, 1.144586, 5, False, True))


def test_flat_window_has_no_zscore(make_bars):
    rows = by_row(signals(make_bars(A=[0.1] * 3), 3), "RollingStd", "ZScore", "IsAnomaly")
    assert rows == [(None, None, False), (0.0, None, False), (0.0, None, False)]
    bands = by_row(signals(make_bars(A=[0.1] * 3), 3), "MovingAvg", "UpperBand", "LowerBand")
    assert bands[2][0] == bands[2][1] == bands[2][2]


def test_missing_close_takes_a_row_but_no_value(make_bars):
    rows = by_row(signals(make_bars(A=[1.0, None, 3.0]), 3), *SIGNALS)
    near(rows[1], (1.0, None, None, None, None, 2, True, False))
    near(
        rows[2], (2.0, 1.414214, 4.828427, -0.828427, 0.707107, 3, False, False)
    )


def test_nan_spreads_and_is_flagged(make_bars):
    rows = by_row(signals(make_bars(A=[1.0, math.nan, 2.0]), 3), "ZScore", "IsAnomaly")
    assert rows[0] == (None, False)
    assert all(math.isnan(z) and flag for z, flag in rows[1:])


def test_window_of_one(make_bars):
    rows = by_row(signals(make_bars(A=[5.0, 7.0]), 1), "MovingAvg", "RollingStd", "ZScore", "IsWarmup")
    assert rows == [(5.0, None, None, False), (7.0, None, None, False)]


@pytest.mark.parametrize("n", [0, -3])
def test_window_below_one_is_refused(make_bars, n):
    with pytest.raises(ValueError):
        rolling_stats(make_bars(A=[1.0]), n)


def test_short_series_is_all_warmup(make_bars):
    rows = by_row(signals(make_bars(A=[1.0, 2.0], B=[1.0] * 4), 4), "Symbol", "IsWarmup")
    assert rows == [("A", True)] * 2 + [("B", True)] * 3 + [("B", False)]


def test_spike_can_be_an_anomaly_during_warmup(make_bars):
    row = by_row(signals(make_bars(A=[5.0] * 5 + [9.0]), 20), *SIGNALS)[5]
    near(row, (5.666667, 1.632993, 8.932653, 2.40068, 2.041241, 6, True, True))


def test_threshold_is_inclusive(make_bars):
    bars = make_bars(A=[1.0, 2.0, 3.0])
    z = by_row(signals(bars, 3, threshold=1.0), "ZScore", "IsAnomaly")
    assert z[2] == (1.0, True)


def test_interleaved_symbols_do_not_mix(make_bars):
    a, b = [1.0, 2.0, 3.0, 4.0], [100.0, 90.0, 95.0, 80.0]
    both = by_row(signals(make_bars(A=a, B=b), 3), "Symbol", *SIGNALS)
    alone = by_row(signals(make_bars(A=a), 3), "Symbol", *SIGNALS)
    alone += by_row(signals(make_bars(B=b), 3), "Symbol", *SIGNALS)
    assert both == alone


def test_decimal_input_types(make_bars):
    bars = make_bars(A=[1.0, 2.0, 4.0]).withColumn("ClosePrice", F.col("ClosePrice").cast("decimal(18,4)"))
    out = signals(bars, 3)
    assert out.schema["MovingAvg"].dataType == T.DecimalType(22, 8)
    for name in ("RollingStd", "UpperBand", "ZScore"):
        assert out.schema[name].dataType == T.DoubleType()
    assert out.schema["RowNum"].dataType == T.IntegerType()
    near(by_row(out, "RollingStd", "UpperBand")[2], (1.527525, 5.388384))


def test_tie_breakers_settle_equal_times(spark):
    rows = [("A", T0, float(v), -v) for v in range(6)]
    bars = spark.createDataFrame(rows, "Symbol string, BarDateTime timestamp_ntz, ClosePrice double, Id long")
    spec = SeriesSpec(tie_breakers=("Id",))
    out = rolling_stats(bars.repartition(4), 2, spec).orderBy("Id").collect()
    assert [r.RowNum for r in out] == [1, 2, 3, 4, 5, 6]
    assert [r.MovingAvg for r in out] == [5.0, 4.5, 3.5, 2.5, 1.5, 0.5]


def test_other_column_names(spark):
    bars = spark.createDataFrame(
        [("x", 1, i, float(i)) for i in range(4)], "venue string, desk int, seq long, px double"
    )
    spec = SeriesSpec(keys=("venue", "desk"), order="seq", value="px")
    out = with_zscore(rolling_stats(bars, 2, spec), 0.5, spec).orderBy("seq").collect()
    assert [r.MovingAvg for r in out] == [0.0, 0.5, 1.5, 2.5]
    assert [r.IsAnomaly for r in out] == [False, True, True, True]


@pytest.mark.parametrize("rows", [1, 30, 50, 5000])
def test_leading_rows_equal_the_start_of_the_whole(spark, rows):
    ticks = tick_series(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    whole = rolling_stats(ticks, 20).orderBy("Symbol", "BarDateTime").limit(rows)
    assert leading_rolling_stats(ticks, 20, rows).collect() == whole.collect()


class TestProperties:
    @pytest.fixture
    def ticks(self, spark):
        return tick_series(spark.read.parquet(f"{SF_SMALL}/events.parquet"))

    @pytest.fixture
    def out(self, ticks):
        return signals(ticks, 20)

    def test_zscore_bound(self, out):
        n = F.least(F.col("RowNum"), F.lit(20)).cast("double")
        bound = (n - 1) / F.sqrt(n) + 1e-9
        assert out.where(F.abs("ZScore") > bound).isEmpty()
        assert out.where("IsAnomaly").agg(F.min("RowNum")).first()[0] >= 6

    def test_bands_enclose_the_average(self, out):
        assert out.where("LowerBand > MovingAvg OR UpperBand < MovingAvg").isEmpty()

    def test_warmup_count_per_symbol(self, out):
        counts = out.groupBy("Symbol").agg(
            F.count("*").alias("n"), F.count_if("IsWarmup").alias("w")
        )
        assert counts.where(F.col("w") != F.least("n", F.lit(19))).isEmpty()

    def test_no_zscore_no_anomaly(self, out):
        assert out.where("ZScore IS NULL AND IsAnomaly").isEmpty()
        assert out.where("IsAnomaly IS NULL OR IsWarmup IS NULL").isEmpty()

    def test_later_bars_change_nothing(self, ticks, out):
        early = F.col("BarDateTime") < "2024-01-15"
        cut = signals(ticks.where(early), 20)
        assert cut.exceptAll(out.where(early)).isEmpty()
        assert out.where(early).exceptAll(cut).isEmpty()

    def test_partitioning_and_row_order_do_not_matter(self, ticks, out):
        shuffled = signals(ticks.repartition(13, F.col("ClosePrice")), 20)
        assert shuffled.exceptAll(out).isEmpty()


def test_bands_only_need_statistics(make_bars):
    out = with_bands(rolling_stats(make_bars(A=[1.0, 3.0]), 2), 0.5)
    near(by_row(out, "UpperBand", "LowerBand")[1], (2.707107, 1.292893))
