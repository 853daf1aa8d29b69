"""Reading bar history with symbol and date filters that reach the storage."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.symbols import SYMBOLS
from tidemark.series import BARS, SeriesSpec
from tidemark.sources.jdbc import JdbcTable

# The columns of a bar table.
HISTORY_COLUMNS = (
    "Symbol",
    "BarDateTime",
    "OpenPrice",
    "HighPrice",
    "LowPrice",
    "ClosePrice",
    "Volume",
)

Day = str | date


def day_range(start: Day | None, end: Day | None) -> tuple[date | None, date | None]:
    """Both days as dates. Text must be a day of the calendar written ``YYYY-MM-DD``, and the
    first day must not come after the last."""
    days = []
    for name, given in (("start", start), ("end", end)):
        day = given
        if isinstance(given, str):
            try:
                day = date.fromisoformat(given)
            except ValueError as error:
                raise ValueError(f"{name} is no day: {given!r}") from error
            if day.isoformat() != given:
                raise ValueError(f"{name} is not written YYYY-MM-DD: {given!r}")
        days.append(day)
    first, last = days
    if first is not None and last is not None and last < first:
        raise ValueError(f"start {first} comes after end {last}")
    return first, last


def history(
    df: DataFrame,
    symbols: Iterable[str] | DataFrame | None = None,
    start: Day | None = None,
    end: Day | None = None,
    *,
    columns: Iterable[str] | None = HISTORY_COLUMNS,
    end_inclusive_day: bool = False,
    fold_case: bool = False,
    nan_as_null: bool = False,
    spec: SeriesSpec = BARS,
) -> DataFrame:
    """Select series and a date range of any bar table.

    ``end`` is included at midnight only, unless ``end_inclusive_day`` is set. ``symbols``
    may be a one-column DataFrame for lists that are data themselves; a list of values of any
    length is a filter that the storage gets. Columns keep their order. ``fold_case``
    upper-cases stored symbols before they are compared; it is off by default because a
    computed column cannot be filtered by the storage.
    """
    key = spec.keys[0]
    if fold_case:
        df = df.withColumn(key, F.upper(key))
    if columns is not None:
        df = df.select(*columns)
    if symbols is not None:
        df = _with_symbols(df, symbols, key)
    first_day, last_day = day_range(start, end)
    if first_day is not None:
        df = df.where(F.col(spec.order) >= _midnight(df, spec.order, first_day))
    if last_day is not None:
        last = _midnight(df, spec.order, last_day)
        if end_inclusive_day:
            df = df.where(F.col(spec.order) < last + F.expr("INTERVAL 1 DAY"))
        else:
            df = df.where(F.col(spec.order) <= last)
    if nan_as_null and isinstance(df.schema[spec.value].dataType, (T.DoubleType, T.FloatType)):
        value = F.col(spec.value)
        df = df.withColumn(spec.value, F.when(~F.isnan(value), value))
    return df


def read_history(
    spark: SparkSession,
    source: JdbcTable | str,
    symbols: Iterable[str] | DataFrame | None = None,
    start: Day | None = None,
    end: Day | None = None,
    *,
    spec: SeriesSpec = BARS,
    **options,
) -> DataFrame:
    """`history` over a JDBC table, a parquet path or a catalog table name.

    The read is lazy. The filters are ordinary DataFrame filters, which Spark hands to
    the database or the parquet reader; nothing is pasted into SQL text.
    """
    day_range(start, end)
    if isinstance(source, JdbcTable):
        df = _load(spark, source, source.read_options(spec.order, start, end))
    else:
        df = read_table(spark, source)
    return history(df, symbols, start, end, spec=spec, **options)


def read_table(spark: SparkSession, source: JdbcTable | str) -> DataFrame:
    """A stored table: JDBC, catalog name, or parquet path (anything with a slash)."""
    if isinstance(source, JdbcTable):
        return _load(spark, source, source.read_options())
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def _load(spark: SparkSession, source: JdbcTable, options: dict[str, str]) -> DataFrame:
    if source.predicates:
        named = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(source.url, source.table, predicates=list(source.predicates), properties=named)
    return spark.read.format("jdbc").options(**options).load()


def with_row_identity(df: DataFrame, file: str = "_file", row: str = "_row") -> DataFrame:
    """Add the file and the row number within it, for tables read from parquet.

    Together they are unique and never change, which makes them tie breakers for bars
    stored more than once under the same key and time.
    """
    return df.select(
        "*",
        F.xxhash64("_metadata.file_path", "_metadata.file_size").alias(file),
        F.col("_metadata.row_index").alias(row),
    )


def _with_symbols(df: DataFrame, symbols: Iterable[str] | DataFrame, key: str) -> DataFrame:
    if not isinstance(symbols, DataFrame):
        return df.where(F.col(key).isin(*SYMBOLS.require(symbols)))
    # No hint: Spark broadcasts the list when its size allows and shuffles otherwise.
    return df.join(symbols.toDF(key), key, "left_semi").select(df.columns)


def _midnight(df: DataFrame, order: str, day: date) -> Column:
    """A literal of the column's own type, so that the column itself is never cast."""
    data_type = df.schema[order].dataType
    kind = data_type.simpleString() if isinstance(data_type, T.DateType) else (
        "timestamp_ntz" if isinstance(data_type, T.TimestampNTZType) else "timestamp"
    )
    return F.lit(day.isoformat()).cast(kind)
