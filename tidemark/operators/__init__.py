from tidemark.operators.indicators import with_bands, with_signals, with_zscore
from tidemark.operators.layout import SeriesLayout, plan_layout
from tidemark.operators.rolling import (
    balanced_rolling_stats,
    leading_rolling_stats,
    rolling_stats,
)

__all__ = [
    "SeriesLayout",
    "balanced_rolling_stats",
    "leading_rolling_stats",
    "plan_layout",
    "rolling_stats",
    "with_bands",
    "with_signals",
    "with_zscore",
]
