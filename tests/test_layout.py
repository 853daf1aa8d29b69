"""Cut series must give exactly what whole series give."""

import math
import random
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import SCHEMA, T0
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from tidemark.operators import balanced_rolling_stats, plan_layout, rolling_stats
from tidemark.operators import layout as layout_module
from tidemark.series import BARS, SeriesSpec


def same(left, right):
    assert left.columns == right.columns
    assert [f.dataType for f in left.schema] == [f.dataType for f in right.schema]
    assert Counter(left.collect()) == Counter(right.collect())


def skewed(spark, n=600, seed=7):
    """A third of all rows in one symbol, half of those within a second."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        symbol = "HOT" if i % 3 == 0 else f"S{rng.randrange(20)}"
        micros = rng.randrange(10**6) if i % 2 else rng.randrange(10**12)
        close = None if rng.random() < 0.1 else rng.randrange(1000) / 100
        rows.append((symbol, T0 + timedelta(microseconds=micros), close))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("rows_per_task", [1, 25])
def test_cut_equals_whole(spark, rows_per_task):
    bars = skewed(spark)
    layout = plan_layout(bars, rows_per_task=rows_per_task)
    for n in (1, 20):
        same(rolling_stats(bars, n, layout=layout), rolling_stats(bars, n))


def piece_sizes(layout, lead=0):
    return layout.in_pieces(lead).groupBy("Symbol", "_cell").count()


def test_pieces_are_bounded_and_cover_everything(spark):
    bars = skewed(spark)
    layout = plan_layout(bars, rows_per_task=25)
    assert piece_sizes(layout).agg(F.max("count")).first()[0] == 25
    assert piece_sizes(layout, 9).agg(F.max("count")).first()[0] == 34
    hot = layout.numbered().where("Symbol = 'HOT'")
    n = bars.where("Symbol = 'HOT'").count()
    assert sorted(r[0] for r in hot.select("_row").collect()) == list(range(1, n + 1))
    assert hot.select("_length").distinct().collect() == [(n,)]


def test_short_series_are_left_alone(spark):
    bars = skewed(spark)
    layout = plan_layout(bars, rows_per_task=150)
    assert layout.is_split
    assert [r.Symbol for r in layout.rows.select("Symbol").distinct().collect()] == ["HOT"]
    assert layout.whole(bars).where("Symbol = 'HOT'").isEmpty()
    assert not plan_layout(bars, rows_per_task=201).is_split
    assert not plan_layout(bars).is_split


def test_default_limit_is_a_fair_share(spark, monkeypatch):
    bars = skewed(spark)
    monkeypatch.setattr(layout_module, "MIN_ROWS_PER_TASK", 10)
    layout = plan_layout(bars)
    # 600 rows over 8 shuffle partitions: only the hot symbol exceeds 75 rows.
    assert layout.rows.select("Symbol").distinct().count() == 1
    assert piece_sizes(layout).agg(F.max("count")).first()[0] == 75
    same(rolling_stats(bars, 5, layout=layout), rolling_stats(bars, 5))
    monkeypatch.setattr(layout_module, "MIN_ROWS_PER_TASK", 199)
    assert plan_layout(bars).is_split
    # A series can pass the minimum and still be within its share.
    monkeypatch.setattr(layout_module, "MIN_ROWS_PER_TASK", 1)
    even = bars.where("Symbol <> 'HOT'")
    assert not plan_layout(even).is_split


def test_large_key_tables_are_shuffled(spark, monkeypatch):
    bars = skewed(spark)
    monkeypatch.setattr(layout_module, "MAX_BROADCAST_BYTES", 0)
    assert not plan_layout(bars, rows_per_task=30).is_small
    same(balanced_rolling_stats(bars, 5, rows_per_task=30), rolling_stats(bars, 5))


TIED = {
    "close doubles": ("double", lambda i: 1 + i * 1e-6),
    "close decimals": ("decimal(18,8)", lambda i: Decimal(1) + Decimal(i).scaleb(-8)),
    "large doubles": ("double", lambda i: 3e14 + i),
    "NaN and null": ("double", lambda i: (None, math.nan, -0.0, float(i))[i % 4]),
}


@pytest.mark.parametrize("name", TIED)
def test_equal_times_are_ordered_by_value(spark, name):
    kind, value = TIED[name]
    rows = [("A", T0, value((i * 37) % 60)) for i in range(60)]
    rows += [("B", T0, value(i // 20)) for i in range(60)]
    bars = spark.createDataFrame(rows, f"Symbol string, BarDateTime timestamp_ntz, ClosePrice {kind}")
    layout = plan_layout(bars, rows_per_task=10)
    assert piece_sizes(layout).agg(F.max("count")).first()[0] == 10
    for n in (1, 4):
        # As text, because NaN differs from itself.
        left = rolling_stats(bars, n, layout=layout).selectExpr("CAST(struct(*) AS string) AS s")
        right = rolling_stats(bars, n).selectExpr("CAST(struct(*) AS string) AS s")
        same(left, right)


@pytest.mark.parametrize("tie", ["long", "string"])
def test_tie_breakers_of_any_type(spark, tie):
    rows = [("A", T0, float(-i), str(2**62 + i)) for i in range(60)]
    rows += [("B", T0, float(i % 3), f"{i}") for i in range(60)] + [("A", None, 1.0, "500")]
    bars = spark.createDataFrame(rows, SCHEMA + ", Id string").withColumn("Id", F.col("Id").cast(tie))
    spec = SeriesSpec(tie_breakers=("Id",))
    same(balanced_rolling_stats(bars, 4, spec, 10), rolling_stats(bars, 4, spec))


def test_equal_rows_are_dealt_out(spark):
    rows = [("A", T0, 2.0)] * 95 + [("A", T0 + timedelta(minutes=i), float(i)) for i in range(1, 9)]
    rows += [("B", T0, None)] * 31 + [("B", T0, 7.0)] * 2 + [(None, None, 1.0)] * 23
    rows += [("C", T0 + timedelta(minutes=i), 5.0) for i in range(9)]
    bars = spark.createDataFrame(rows, SCHEMA)
    layout = plan_layout(bars, rows_per_task=10)
    assert piece_sizes(layout).agg(F.max("count")).first()[0] == 10
    assert layout.rows.count() == len(rows) - 9
    for n in (1, 15):
        same(rolling_stats(bars, n, layout=layout), rolling_stats(bars, n))


def test_map_columns_pass_through(spark):
    bars = skewed(spark).withColumn("Tags", F.create_map(F.lit("k"), F.col("Symbol")))
    cut, whole = balanced_rolling_stats(bars, 5, rows_per_task=30), rolling_stats(bars, 5)
    as_text = [F.col(c) if c != "Tags" else F.to_json(c).alias(c) for c in whole.columns]
    same(cut.select(*as_text), whole.select(*as_text))


def test_missing_keys_and_times(spark):
    rows = [(None, T0 + timedelta(minutes=i), float(i)) for i in range(40)]
    rows += [("A", None if i % 5 == 0 else T0 + timedelta(minutes=i), float(i)) for i in range(40)]
    bars = spark.createDataFrame(rows, SCHEMA)
    same(balanced_rolling_stats(bars, 6, rows_per_task=5), rolling_stats(bars, 6))


@pytest.mark.parametrize(
    ("kind", "value"),
    [
        ("date", lambda i: date(2020, 1, 1) + timedelta(days=i * i)),
        ("long", lambda i: (i - 20) * 2**57),
        ("timestamp", lambda i: datetime(1969, 12, 31) + timedelta(hours=i)),
        ("double", lambda i: (i - 20) / 7),
        ("decimal(20,9)", lambda i: Decimal(i - 20).scaleb(-9)),
        ("string", lambda i: f"{i:03}"),
    ],
)
def test_other_order_types(spark, kind, value):
    rows = [("A", value(i), float(i * 7 % 11)) for i in range(40)]
    bars = spark.createDataFrame(rows, f"Symbol string, BarDateTime {kind}, ClosePrice double")
    layout = plan_layout(bars, rows_per_task=6)
    assert piece_sizes(layout).count() == 7
    same(rolling_stats(bars, 5, layout=layout), rolling_stats(bars, 5))


def test_clock_changes_do_not_reorder_local_times(spark):
    start = datetime(2024, 3, 31, 1, 0)  # clocks in Berlin skip 02:00 to 03:00 that night
    rows = [("A", start + timedelta(minutes=5 * i), float(i)) for i in range(40)]
    bars = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        same(balanced_rolling_stats(bars, 6, rows_per_task=4), rolling_stats(bars, 6))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_refuses_a_limit_below_one(spark):
    with pytest.raises(ValueError):
        plan_layout(skewed(spark), rows_per_task=0)


def test_extra_columns_pass_through(spark):
    bars = skewed(spark).withColumn("Volume", F.lit(3)).withColumn("Note", F.lit("x"))
    same(balanced_rolling_stats(bars, 5, rows_per_task=30), rolling_stats(bars, 5))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from("AB"),
            st.integers(0, 3) | st.integers(0, 10**9),
            st.none() | st.integers(0, 50),
        ),
        min_size=1,
        max_size=60,
    ),
    st.integers(1, 8),
    st.integers(1, 12),
)
def test_any_series(spark, rows, n, rows_per_task):
    bars = spark.createDataFrame(
        [
            (s, T0 + timedelta(microseconds=m), None if c is None else c * 1e-7)
            for s, m, c in rows
        ],
        SCHEMA,
    )
    same(balanced_rolling_stats(bars, n, BARS, rows_per_task), rolling_stats(bars, n))
