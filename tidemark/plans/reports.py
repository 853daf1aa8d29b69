"""Summaries over the two result tables and the report frames made of them.

Rows of the warm-up phase are left out everywhere except in `top_anomalies`, which keeps
them unless told otherwise. All functions read the whole tables they are given; to report
on one run only, pass them through `one_batch` first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import count_text, minute_text, number_text

# The length and the wording of the report.
DEFAULT_TOP = 15
OVERALL_METRICS = (
    "Symbols",
    "Date range",
    "Bollinger rows (excl. warmup)",
    "Z-Score rows (excl. warmup)",
    "Anomalies flagged",
)
SYMBOL_HEADERS = (
    "Symbol",
    "Bars",
    "Min Close",
    "Max Close",
    "Avg Close",
    "Anomalies",
    "Max |Z|",
)
ANOMALY_HEADERS = ("Symbol", "Bar Date/Time", "Close Price", "Z-Score")
NO_ANOMALIES = "No anomalies flagged in the current data."
DATE_ARROW = " → "


def one_batch(df: DataFrame, batch_id: str) -> DataFrame:
    """The rows one run wrote."""
    return df.where(F.col("BatchId") == batch_id)


def latest_rows(
    df: DataFrame, keys: tuple[str, ...] = ("Symbol", "BarDateTime", "WindowSize")
) -> DataFrame:
    """Of rows that several runs wrote for one bar and window, the one of the latest run.

    Runs are compared by load time, then by batch id. One aggregation without a join: a single
    row per key is shuffled by every task, and none where the table is bucketed by one of the
    keys. Rows of one run that share a key become one as well, the largest of them.
    """
    others = [c for c in df.columns if c not in keys]
    rank = [c for c in ("LoadDate", "BatchId") if c in others]
    ordered = [*rank, *(c for c in others if c not in rank)]
    best = F.max(F.struct(*[F.col(c) for c in ordered])).alias("_row")
    return df.groupBy(*keys).agg(best).select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def settled(df: DataFrame) -> DataFrame:
    """Rows whose window was complete."""
    return df.where(~F.col("IsWarmup"))


def price_groups(bands: DataFrame) -> DataFrame:
    """Bar count, date range and close range of every symbol, in no order."""
    return settled(bands).groupBy("Symbol").agg(*_price_aggregates())


def anomaly_groups(zscores: DataFrame) -> DataFrame:
    """Bar count, anomaly count and largest absolute z-score of every symbol, in no order."""
    count = F.count(F.lit(1)).alias("BarCount")
    return settled(zscores).groupBy("Symbol").agg(count, *_anomaly_aggregates())


def bollinger_summary(bands: DataFrame) -> DataFrame:
    """`price_groups` in symbol order."""
    return _sorted(price_groups(bands), "Symbol")


def zscore_summary(zscores: DataFrame) -> DataFrame:
    """`anomaly_groups`, most anomalies first."""
    return _sorted(anomaly_groups(zscores), F.desc("AnomalyCount"), "Symbol")


def symbol_summary(signals: DataFrame) -> DataFrame:
    """Both summaries in one pass, for a frame that carries bands and z-scores."""
    summary = settled(signals).groupBy("Symbol").agg(*_price_aggregates(), *_anomaly_aggregates())
    return _sorted(summary, "Symbol")


def top_anomalies(
    zscores: DataFrame, limit: int = DEFAULT_TOP, include_warmup: bool = True
) -> DataFrame:
    """The most extreme anomalies of all symbols; equal scores in symbol and time order."""
    rows = zscores if include_warmup else settled(zscores)
    return (
        rows.where(F.col("IsAnomaly"))
        .select("Symbol", "BarDateTime", "ClosePrice", "ZScore")
        .orderBy(F.abs("ZScore").desc(), "Symbol", "BarDateTime")
        .limit(limit)
    )


def overall_totals(bands: DataFrame, zscores: DataFrame) -> DataFrame:
    """Headline figures in one row.

    Symbols and dates come from the band table, anomalies from the z-score table. On
    empty tables the counts are 0 and the anomaly total is missing.
    """
    from_bands = settled(bands).agg(*_headline_aggregates("TotalBollingerRows"))
    from_zscores = settled(zscores).agg(
        F.struct(
            F.count(F.lit(1)).alias("TotalZScoreRows"), _anomaly_total().alias("TotalAnomalies")
        )
    )
    return from_bands.withColumn("_scores", from_zscores.scalar()).select(
        *from_bands.columns, "_scores.*"
    )


def overall_totals_from_signals(signals: DataFrame) -> DataFrame:
    """The same figures in one pass, for a frame that carries bands and z-scores."""
    return (
        settled(signals)
        .agg(*_headline_aggregates("TotalBollingerRows"), _anomaly_total().alias("TotalAnomalies"))
        .select(
            "SymbolCount",
            "TotalBollingerRows",
            "MinDate",
            "MaxDate",
            F.col("TotalBollingerRows").alias("TotalZScoreRows"),
            "TotalAnomalies",
        )
    )


def overall_report(totals: DataFrame) -> DataFrame:
    """The headline figures as five (Metric, Value) rows."""
    first, last = minute_text(F.col("MinDate")), minute_text(F.col("MaxDate"))
    values = [
        count_text(F.col("SymbolCount")),
        F.concat(first, F.lit(DATE_ARROW), last),
        count_text(F.col("TotalBollingerRows")),
        count_text(F.col("TotalZScoreRows")),
        count_text(F.col("TotalAnomalies")),
    ]
    cells = [
        F.struct(F.lit(metric).alias("Metric"), value.alias("Value"))
        for metric, value in zip(OVERALL_METRICS, values, strict=True)
    ]
    return totals.select(F.inline(F.array(*cells)))


def per_symbol_report(
    prices: DataFrame, anomalies: DataFrame, null_safe: bool = True
) -> DataFrame:
    """Rows of `price_groups` and `anomaly_groups` side by side, as text, one per symbol of the
    first.

    Symbols without a z-score row show no anomalies; symbols with nothing else are left out.
    The join is null-safe, so neither side gets a filter of its own: where both groups come from
    one frame, its shuffle and its sort are done once. Stored tables have no missing symbols; with
    ``null_safe=False`` two that are bucketed alike are joined bucket by bucket.
    """
    right = anomalies.select(F.col("Symbol").alias("_symbol"), "AnomalyCount", "MaxAbsZScore")
    left, other = F.col("Symbol"), F.col("_symbol")
    return symbol_report(prices.join(right, left.eqNullSafe(other) if null_safe else left == other, "left"))


def symbol_report(summary: DataFrame) -> DataFrame:
    """Report text for rows shaped like `symbol_summary`."""
    text = summary.select(
        "Symbol",
        "BarCount",
        *[number_text(F.col(c)) for c in ("MinClose", "MaxClose", "AvgClose")],
        F.coalesce("AnomalyCount", F.lit(0)),
        number_text(F.col("MaxAbsZScore")),
    ).toDF(*SYMBOL_HEADERS)
    return _sorted(text, "Symbol")


def top_anomaly_report(anomalies: DataFrame) -> DataFrame:
    """Report text for the rows of `top_anomalies`, in their order."""
    return anomalies.select(
        "Symbol",
        minute_text(F.col("BarDateTime")),
        number_text(F.col("ClosePrice")),
        number_text(F.col("ZScore"), 3),
    ).toDF(*ANOMALY_HEADERS)


def no_anomaly_note(zscores: DataFrame) -> DataFrame:
    """One row with a sentence when nothing was flagged, otherwise no row."""
    return (
        zscores.where(F.col("IsAnomaly"))
        .limit(1)
        .agg(F.count(F.lit(1)).alias("_flagged"))
        .where(F.col("_flagged") == 0)
        .select(F.lit(NO_ANOMALIES).alias("Note"))
    )


def _sorted(summary: DataFrame, *order) -> DataFrame:
    """Sort a per-symbol frame without computing it twice.

    A global sort first runs its input once to find the range bounds. Shuffling the few
    summary rows beforehand makes that run read them instead of repeating the windows.
    (The optimizer would drop a plain repartition before a sort.)
    """
    return summary.hint("rebalance", "Symbol").orderBy(*order)


def _price_aggregates():
    return [
        F.count(F.lit(1)).alias("BarCount"),
        F.min("BarDateTime").alias("MinDate"),
        F.max("BarDateTime").alias("MaxDate"),
        F.min("ClosePrice").alias("MinClose"),
        F.max("ClosePrice").alias("MaxClose"),
        F.round(F.avg("ClosePrice"), 6).alias("AvgClose"),
    ]


def _anomaly_aggregates():
    return [
        _anomaly_total().alias("AnomalyCount"),
        F.max(F.abs("ZScore")).alias("MaxAbsZScore"),
    ]


def _headline_aggregates(rows: str):
    return [
        F.count_distinct("Symbol").alias("SymbolCount"),
        F.count(F.lit(1)).alias(rows),
        F.min("BarDateTime").alias("MinDate"),
        F.max("BarDateTime").alias("MaxDate"),
    ]


def _anomaly_total():
    return F.sum(F.when(F.col("IsAnomaly"), 1).otherwise(0))
