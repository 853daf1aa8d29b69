import pytest

from pyspark.sql import functions as F
from tidemark.functions import (
    SYMBOLS,
    SymbolRule,
    count_text,
    minute_text,
    number_text,
    split_symbols,
    symbol_list,
)
from tidemark.functions.symbols import WHITE_SPACE


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "s string")


def test_symbols_given_as_values():
    given = [" aapl ", "BRK.B", "", "  ", "rds-a", "A\n", "\tq", "AAPL"]
    assert SYMBOLS.require(given) == ("AAPL", "BRK.B", "RDS-A", "A", "Q")
    for bad in (["A B"], ["X'Y"], ["A;--"], ["É"], ["A\nB"]):
        with pytest.raises(ValueError, match="expected symbols"):
            SYMBOLS.require(bad)
    for empty in ([], ["", " "]):
        with pytest.raises(ValueError, match="an empty list"):
            SYMBOLS.require(empty)


def test_all_bad_symbols_are_named_at_once():
    with pytest.raises(ValueError, match="'A B', 'X!'"):
        SYMBOLS.require(["a b", "OK", "x!", "A B"])
    assert SymbolRule("[A-Z]+:[A-Z]+").require(["xnas:aapl"]) == ("XNAS:AAPL",)


def test_symbols_of_a_column_follow_the_same_rule(spark):
    raw = [" aapl ", "BRK.B", "A B", "X'Y", "", "A\n", "\tq", " msft　", "\x1cz", None, "É"]
    out = SYMBOLS.judged(texts(spark, *raw), "s").collect()
    assert [(r.Symbol, r.IsValid) for r in out] == [
        ("AAPL", True),
        ("BRK.B", True),
        ("A B", False),
        ("X'Y", False),
        ("A", True),
        ("Q", True),
        ("MSFT", True),
        ("Z", True),
        ("É", False),
    ]


def test_white_space_is_all_there_is():
    import sys

    assert set(WHITE_SPACE) == {chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace()}


def test_symbol_lists(spark):
    df = texts(spark, " AAPL, MSFT ,,TSLA", "AAPL,MSFT", " , ", "one\t,\ttwo", None)
    assert [r[0] for r in df.select(symbol_list(F.col("s"))).collect()] == [
        ["AAPL", "MSFT", "TSLA"],
        ["AAPL", "MSFT"],
        [],
        ["one", "two"],
        None,
    ]
    assert [r.Symbol for r in split_symbols(df, "s").collect()] == [
        "AAPL", "MSFT", "TSLA", "AAPL", "MSFT", "one", "two",
    ]


def test_numbers_are_written_like_printf(spark):
    values = [0.125, 2.675, 0.375, 1.005, 12.345, -0.125, -2.5, 0.0, 1234567.891, 1e15, 155.0, 2.1]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for decimals in (2, 3, 0):
        out = [r[0] for r in df.select(number_text(F.col("x"), decimals)).collect()]
        assert out == [f"{v:.{decimals}f}" for v in values]
    missing = spark.sql("select cast(null as double) x, cast(2.10 as decimal(18,4)) d")
    assert missing.select(number_text(F.col("x")), number_text(F.col("d"))).first() == ("-", "2.10")


def test_times_and_counts(spark):
    df = spark.sql(
        "select timestamp_ntz'2025-11-01 09:30:59.9' a, timestamp'2025-11-01 09:30:00' b,"
        " cast(null as timestamp) c, 3L n, cast(null as bigint) m"
    )
    out = df.select(*[minute_text(F.col(c)) for c in "abc"], *[count_text(F.col(c)) for c in "nm"])
    assert tuple(out.first()) == ("2025-11-01 09:30", "2025-11-01 09:30", "-", "3", "-")
