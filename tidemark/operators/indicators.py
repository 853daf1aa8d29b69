"""Indicators computed row by row from the trailing statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.series import BARS, SeriesSpec


def with_bands(df: DataFrame, k: float = 2.0) -> DataFrame:
    """Append UpperBand and LowerBand, ``k`` standard deviations around MovingAvg."""
    return df.withColumns(_bands(k))


def with_zscore(df: DataFrame, threshold: float = 2.0, spec: SeriesSpec = BARS) -> DataFrame:
    """Append ZScore and IsAnomaly.

    ZScore is missing where the window has no spread, and such a row is no anomaly.
    """
    return df.withColumn("ZScore", _zscore(spec)).withColumn("IsAnomaly", _anomaly(threshold))


def with_signals(
    df: DataFrame, k: float = 2.0, threshold: float = 2.0, spec: SeriesSpec = BARS
) -> DataFrame:
    """Bands and z-score side by side, for consumers that need both from one pass."""
    return with_zscore(with_bands(df, k), threshold, spec)


def _bands(k: float) -> dict[str, Column]:
    width = F.lit(float(k)) * F.col("RollingStd")
    return {"UpperBand": F.col("MovingAvg") + width, "LowerBand": F.col("MovingAvg") - width}


def _zscore(spec: SeriesSpec) -> Column:
    distance = F.col(spec.value) - F.col("MovingAvg")
    return F.when(F.col("RollingStd") > 0, distance / F.col("RollingStd"))


def _anomaly(threshold: float) -> Column:
    return F.coalesce(F.abs("ZScore") >= F.lit(float(threshold)), F.lit(False))
