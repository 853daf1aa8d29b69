"""Rolling statistics, Bollinger bands and anomaly scores for bar series on Spark."""

from tidemark.series import BARS, SeriesSpec

__all__ = ["BARS", "SeriesSpec"]
