"""The two result tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Names, order and types of the stored columns.
_PRICE = T.DecimalType(18, 4)
_STATISTIC = T.DecimalType(18, 8)
_PARAMETER = T.DecimalType(9, 4)


def _table(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in columns])


BANDS_TABLE = _table(
    ("Symbol", T.StringType(), False),
    ("BarDateTime", T.TimestampNTZType(), False),
    ("ClosePrice", _PRICE, True),
    ("WindowSize", T.IntegerType(), False),
    ("NumStdDev", _PARAMETER, False),
    ("MovingAvg", _STATISTIC, True),
    ("RollingStd", _STATISTIC, True),
    ("UpperBand", _STATISTIC, True),
    ("LowerBand", _STATISTIC, True),
    ("IsWarmup", T.BooleanType(), False),
    ("LoadDate", T.TimestampNTZType(), False),
    ("BatchId", T.StringType(), False),
)

ZSCORE_TABLE = _table(
    ("Symbol", T.StringType(), False),
    ("BarDateTime", T.TimestampNTZType(), False),
    ("ClosePrice", _PRICE, True),
    ("WindowSize", T.IntegerType(), False),
    ("MovingAvg", _STATISTIC, True),
    ("RollingStd", _STATISTIC, True),
    ("ZScore", _STATISTIC, True),
    ("ZThreshold", _PARAMETER, False),
    ("IsAnomaly", T.BooleanType(), False),
    ("IsWarmup", T.BooleanType(), False),
    ("LoadDate", T.TimestampNTZType(), False),
    ("BatchId", T.StringType(), False),
)

# What an analyst sees before a run is stamped and stored.
BANDS_COLUMNS = (
    "Symbol",
    "BarDateTime",
    "ClosePrice",
    "MovingAvg",
    "RollingStd",
    "UpperBand",
    "LowerBand",
    "IsWarmup",
)
ZSCORE_COLUMNS = (
    "Symbol",
    "BarDateTime",
    "ClosePrice",
    "MovingAvg",
    "RollingStd",
    "ZScore",
    "IsAnomaly",
    "IsWarmup",
)
