from datetime import datetime

import pytest
from conftest import T0

from pyspark.sql import functions as F
from tidemark.operators import rolling_stats, with_signals
from tidemark.plans import reports
from tidemark.sinks import RunStamp, zscore_output

STORED = (
    "Symbol string, BarDateTime timestamp_ntz, ClosePrice decimal(18,4), ZScore decimal(18,8),"
    " IsAnomaly boolean, IsWarmup boolean, BatchId string"
)


@pytest.fixture
def stored(spark):
    """Rows that serve as both result tables."""
    from decimal import Decimal as D

    def row(symbol, minute, close, z, flag, warmup=False, batch="b1"):
        return (
            symbol,
            T0.replace(minute=minute),
            None if close is None else D(str(close)),
            None if z is None else D(str(z)),
            flag,
            warmup,
            batch,
        )

    return spark.createDataFrame(
        [
            row("LUNR", 1, 10, None, False, warmup=True),
            row("LUNR", 2, 14, 3.4, True, warmup=True),
            row("LUNR", 3, 12, -2.5, True),
            row("LUNR", 4, 13, 2.5, True),
            row("AAPL", 1, 150, 0.5, False),
            row("AAPL", 2, 160, -2.1, True),
            row("AAPL", 3, None, None, False),
            row("ZZZ", 1, 1, None, False, warmup=True),
        ],
        STORED,
    )


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_bollinger_summary(stored):
    out = rows(reports.bollinger_summary(stored).selectExpr(
        "Symbol", "BarCount", "MinDate", "MaxDate", "double(MinClose)", "double(MaxClose)", "double(AvgClose)"))
    assert out == [
        ("AAPL", 3, T0.replace(minute=1), T0.replace(minute=3), 150.0, 160.0, 155.0),
        ("LUNR", 2, T0.replace(minute=3), T0.replace(minute=4), 12.0, 13.0, 12.5),
    ]


def test_zscore_summary_puts_most_anomalies_first(stored):
    out = rows(reports.zscore_summary(stored).withColumn("MaxAbsZScore", F.col("MaxAbsZScore").cast("double")))
    assert out == [("LUNR", 2, 2, 2.5), ("AAPL", 3, 1, 2.1)]


def test_top_anomalies_keep_warmup_unless_told(stored):
    top = [(r.Symbol, float(r.ZScore)) for r in reports.top_anomalies(stored).collect()]
    assert top == [("LUNR", 3.4), ("LUNR", -2.5), ("LUNR", 2.5), ("AAPL", -2.1)]
    settled = reports.top_anomalies(stored, limit=2, include_warmup=False).collect()
    assert [float(r.ZScore) for r in settled] == [-2.5, 2.5]


def test_overall_totals(stored):
    row = reports.overall_totals(stored, stored).first()
    assert tuple(row) == (2, 5, T0.replace(minute=1), T0.replace(minute=4), 5, 3)
    assert reports.overall_totals_from_signals(stored).first() == row
    # Symbols and dates come from the first table, anomalies from the second.
    split = reports.overall_totals(stored.where("Symbol = 'AAPL'"), stored).first()
    assert (split.SymbolCount, split.TotalBollingerRows, split.TotalZScoreRows) == (1, 3, 5)


def test_totals_of_empty_tables(stored):
    none = stored.where("false")
    assert tuple(reports.overall_totals(none, none).first()) == (0, 0, None, None, 0, None)
    assert tuple(reports.overall_totals_from_signals(none).first()) == (0, 0, None, None, 0, None)
    assert rows(reports.overall_report(reports.overall_totals(none, none))) == [
        ("Symbols", "0"),
        ("Date range", "- → -"),
        ("Bollinger rows (excl. warmup)", "0"),
        ("Z-Score rows (excl. warmup)", "0"),
        ("Anomalies flagged", "-"),
    ]
    for frame in (reports.bollinger_summary(none), reports.top_anomalies(none)):
        assert frame.isEmpty()


def test_overall_report(stored):
    assert rows(reports.overall_report(reports.overall_totals(stored, stored))) == [
        ("Symbols", "2"),
        ("Date range", "2024-03-04 09:01 → 2024-03-04 09:04"),
        ("Bollinger rows (excl. warmup)", "5"),
        ("Z-Score rows (excl. warmup)", "5"),
        ("Anomalies flagged", "3"),
    ]


def test_per_symbol_report_is_a_left_join(spark):
    prices = spark.createDataFrame(
        [("LUNR", 50, 10.0, 14.0, 12.0), ("AAPL", 50, 150.0, 160.0, 155.0), ("NEW", 1, None, None, None)],
        "Symbol string, BarCount long, MinClose double, MaxClose double, AvgClose double",
    )
    anomalies = spark.createDataFrame(
        [("AAPL", 50, 1, 2.1), ("LUNR", 50, 2, 3.4), ("GONE", 9, 9, 9.0), ("aapl", 1, 7, 7.0)],
        "Symbol string, BarCount long, AnomalyCount long, MaxAbsZScore double",
    )
    out = reports.per_symbol_report(prices, anomalies)
    assert out.columns == ["Symbol", "Bars", "Min Close", "Max Close", "Avg Close", "Anomalies", "Max |Z|"]
    assert rows(out) == [
        ("AAPL", 50, "150.00", "160.00", "155.00", 1, "2.10"),
        ("LUNR", 50, "10.00", "14.00", "12.00", 2, "3.40"),
        ("NEW", 1, "-", "-", "-", 0, "-"),
    ]


def test_one_pass_report_equals_the_join(stored):
    joined = reports.per_symbol_report(
        reports.price_groups(stored), reports.anomaly_groups(stored)
    )
    one_pass = reports.symbol_report(reports.symbol_summary(stored))
    assert rows(one_pass) == rows(joined) and one_pass.schema == joined.schema


def test_top_anomaly_report(spark, stored):
    top = spark.createDataFrame(
        [("LUNR", datetime(2025, 11, 1, 9, 30), 13.5, 3.4)],
        "Symbol string, BarDateTime timestamp_ntz, ClosePrice double, ZScore double",
    )
    out = reports.top_anomaly_report(top)
    assert out.columns == ["Symbol", "Bar Date/Time", "Close Price", "Z-Score"]
    assert rows(out) == [("LUNR", "2025-11-01 09:30", "13.50", "3.400")]
    assert [r[3] for r in reports.top_anomaly_report(reports.top_anomalies(stored)).collect()] == [
        "3.400", "-2.500", "2.500", "-2.100",
    ]


def test_note_appears_only_without_anomalies(stored):
    assert rows(reports.no_anomaly_note(stored)) == []
    calm = stored.where("NOT IsAnomaly")
    assert rows(reports.no_anomaly_note(calm)) == [("No anomalies flagged in the current data.",)]


def test_second_batch_doubles_counts_but_not_symbols(make_bars):
    signals = with_signals(rolling_stats(make_bars(A=[1.0, 2.0, 9.0], B=[1.0, 2.0, 3.0]), 2), 2.0, 0.7)
    runs = [zscore_output(signals, 2, 0.7, RunStamp(b)) for b in ("b1", "b2")]
    both = runs[0].unionByName(runs[1])
    one, two = reports.overall_totals(runs[0], runs[0]).first(), reports.overall_totals(both, both).first()
    assert one.SymbolCount == two.SymbolCount == 2
    assert (two.TotalBollingerRows, two.TotalAnomalies) == (
        2 * one.TotalBollingerRows, 2 * one.TotalAnomalies)
    alone = reports.one_batch(both, "b2")
    assert reports.overall_totals(alone, alone).first() == one
