
from __future__ import annotations

import os
from collections.abc import Callable
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import SYMBOLS as SYMBOL_RULE
from tidemark.functions import split_symbols
from tidemark.functions.symbols import WHITE_SPACE
from tidemark.operators import (
    balanced_rolling_stats,
    rolling_stats,
    with_bands,
    with_signals,
    with_zscore,
)
from tidemark.plans import job, reports
from tidemark.scratch import ensure_checkpoint_dir, remove_folder
from tidemark.series import SeriesSpec
from tidemark.sinks import (
    BANDS_COLUMNS,
    BANDS_TABLE,
    ZSCORE_COLUMNS,
    ZSCORE_TABLE,
    BatchLog,
    RunStamp,
    TableLayout,
    bands_output,
    create_table,
    save,
    with_bar_day,
    zscore_output,
)
from tidemark.sources import history, quantile_bounds, slice_predicates
from tidemark.sources.views import EVENTS_SCHEMA, hourly_bars, tick_series

WINDOW, NUM_STD, THRESHOLD = 20, 2.0, 2.0
SMALL_WINDOW = 5
START, END = "2024-01-05", "2024-01-20"
SYMBOLS = ("CLICK", "error", " view ")
# Averages of 160 or 192 closes often end in a 5 behind the sixth decimal, of no more rows behind the ninth.
WIDE_WINDOW, WIDE_DECIMALS = 200, 9
# Two runs that overlap: up to the last day of one, from the first of the other.
FIRST_RUN_END, SECOND_RUN_START = "2024-01-20", "2024-01-10"
BUCKETS = 8
SLICES = 8
# Series longer than this are cut in the *_cut queries, which makes the cutting visible
# on the small tables; the other queries let the table decide.
CUT_ROWS = 40

STAMP = RunStamp("7b1f6f0e-64a5-4a32-9c2f-0d2a5a6f9e11", datetime(2024, 2, 1, 6, 30))
SECOND_STAMP = RunStamp("c4d2b8a1-53f0-4c1d-8a60-91d3a7f2be02", datetime(2024, 2, 2, 6, 30))

SAMPLE_DIR = "/root/testdata/sf0.001"

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: rolling z-scores and anomaly flags of every user's event series."""
    return _zscore_anomalies(spark, SAMPLE_DIR)


# --- inputs ----------------------------------------------------------------------------


_SCHEMAS = {
    "events": EVENTS_SCHEMA,
    "part": "p_name string, p_type string",
    "nation": "n_name string",
    "documents": "doc_id bigint, text string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.schema(_SCHEMAS[name]).parquet(path)


def _ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tick_series(_table(spark, sf_dir, "events"))


def _bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregated once and kept: the layout of long series and the statistics both read them."""
    bars = hourly_bars(_table(spark, sf_dir, "events"))
    ensure_checkpoint_dir(spark)
    return bars.select("Symbol", "BarDateTime", "ClosePrice").checkpoint()


def _tick_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_rolling_stats(_ticks(spark, sf_dir), WINDOW)


def _bar_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_rolling_stats(_bars(spark, sf_dir), WINDOW)


def _tick_outputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    stats = _tick_stats(spark, sf_dir)
    return (
        bands_output(with_bands(stats, NUM_STD), WINDOW, NUM_STD, STAMP),
        zscore_output(with_zscore(stats, THRESHOLD), WINDOW, THRESHOLD, STAMP),
    )


def _tick_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both stored tables side by side, in their stored types."""
    signals = with_signals(_tick_stats(spark, sf_dir), NUM_STD, THRESHOLD)
    return signals.select(
        "Symbol",
        "BarDateTime",
        F.col("ClosePrice").cast("decimal(18,4)").alias("ClosePrice"),
        F.col("ZScore").cast("decimal(18,8)").alias("ZScore"),
        "IsAnomaly",
        "IsWarmup",
    )


def _bar_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = with_zscore(_bar_stats(spark, sf_dir), THRESHOLD)
    return zscore_output(scores, WINDOW, THRESHOLD, STAMP)


def _comparable(df: DataFrame, decimals: int = 6) -> DataFrame:
    """Doubles for decimals and six decimals for doubles, as the SQL side has them."""
    columns = []
    for column in df.schema.fields:
        if isinstance(column.dataType, T.DecimalType):
            columns.append(F.col(f"`{column.name}`").cast("double").alias(column.name))
        elif isinstance(column.dataType, T.DoubleType):
            columns.append(F.round(f"`{column.name}`", decimals).alias(column.name))
        else:
            columns.append(F.col(f"`{column.name}`"))
    return df.select(*columns)


# --- queries ---------------------------------------------------------------------------


def _history_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = hourly_bars(_table(spark, sf_dir, "events"), START, END)
    return _comparable(history(bars, SYMBOLS, START, END))


def _history_scan_whole_end_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = _ticks(spark, sf_dir)
    return history(ticks, None, START, END, columns=None, end_inclusive_day=True)


def _moving_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_tick_stats(spark, sf_dir))


def _moving_stats_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(balanced_rolling_stats(_ticks(spark, sf_dir), WINDOW, rows_per_task=CUT_ROWS))


DAILY = SeriesSpec(order="Day")
SPELLED = SeriesSpec(order="Spelled")


def _moving_stats_cut_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days as times, so that many rows share one and the value orders them."""
    ticks = _ticks(spark, sf_dir).withColumn("Day", F.to_date("BarDateTime"))
    daily = ticks.select("Symbol", "Day", "ClosePrice")
    return _comparable(balanced_rolling_stats(daily, WINDOW, DAILY, CUT_ROWS))


def _moving_stats_cut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as text."""
    ticks = _ticks(spark, sf_dir)
    spelled = ticks.select(
        "Symbol", F.date_format("BarDateTime", "yyyy-MM-dd HH:mm:ss").alias("Spelled"), "ClosePrice"
    )
    return _comparable(balanced_rolling_stats(spelled, WINDOW, SPELLED, CUT_ROWS))


def _moving_stats_small_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(balanced_rolling_stats(_ticks(spark, sf_dir), SMALL_WINDOW))


def _moving_stats_single_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(balanced_rolling_stats(_ticks(spark, sf_dir), 1))


def _moving_stats_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = _ticks(spark, sf_dir)
    ticks = ticks.withColumn("ClosePrice", F.col("ClosePrice").cast("decimal(18,4)"))
    stats = balanced_rolling_stats(ticks, WINDOW)
    # The average of decimals is a decimal; as a double it compares at six decimals.
    return _comparable(stats.withColumn("MovingAvg", F.col("MovingAvg").cast("double")))


def _moving_stats_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = history(_ticks(spark, sf_dir), None, START, END, columns=None)
    return _comparable(balanced_rolling_stats(ticks, WINDOW))


def _moving_stats_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(balanced_rolling_stats(_bars(spark, sf_dir), WIDE_WINDOW), WIDE_DECIMALS)


def _moving_stats_wide_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = _bars(spark, sf_dir)
    return _comparable(balanced_rolling_stats(bars, WIDE_WINDOW, rows_per_task=CUT_ROWS), WIDE_DECIMALS)


def _moving_stats_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(balanced_rolling_stats(_ticks(spark, sf_dir), WINDOW, wide=True))


def _history_in_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every slice that a database would be asked for, one after the other."""
    ticks = _ticks(spark, sf_dir)
    slices = slice_predicates("BarDateTime", quantile_bounds(ticks, "BarDateTime", SLICES))
    parts = [ticks.where(p) for p in slices]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _bollinger_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(with_bands(_tick_stats(spark, sf_dir), NUM_STD).select(*BANDS_COLUMNS))


def _zscore_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(with_zscore(_tick_stats(spark, sf_dir), THRESHOLD).select(*ZSCORE_COLUMNS))


def _zscore_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(with_zscore(_bar_stats(spark, sf_dir), THRESHOLD).select(*ZSCORE_COLUMNS))


def _zscore_bars_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = balanced_rolling_stats(_bars(spark, sf_dir), WINDOW, rows_per_task=CUT_ROWS)
    return _comparable(with_zscore(stats, THRESHOLD).select(*ZSCORE_COLUMNS))


def _bollinger_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_tick_outputs(spark, sf_dir)[0])


def _zscore_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_tick_outputs(spark, sf_dir)[1])


def _bollinger_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(job.bands_preview(_ticks(spark, sf_dir), WINDOW, NUM_STD))


def _zscore_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(job.zscore_preview(_ticks(spark, sf_dir), WINDOW, THRESHOLD))


def _bollinger_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(reports.bollinger_summary(_tick_outputs(spark, sf_dir)[0]))


def _zscore_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(reports.zscore_summary(_tick_outputs(spark, sf_dir)[1]))


def _top_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(reports.top_anomalies(_bar_scores(spark, sf_dir)))


def _top_anomalies_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(
        reports.top_anomalies(_bar_scores(spark, sf_dir), include_warmup=False)
    )


def _top_anomalies_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(reports.top_anomalies(_tick_outputs(spark, sf_dir)[1], limit=50))


def _overall_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.overall_totals(*_tick_outputs(spark, sf_dir))


def _overall_totals_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.overall_totals_from_signals(_tick_signals(spark, sf_dir))


def _per_symbol_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands, scores = _tick_outputs(spark, sf_dir)
    return reports.per_symbol_report(reports.price_groups(bands), reports.anomaly_groups(scores))


def _per_symbol_report_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.symbol_report(reports.symbol_summary(_tick_signals(spark, sf_dir)))


def _overall_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.overall_report(reports.overall_totals(*_tick_outputs(spark, sf_dir)))


def _top_anomaly_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_anomaly_report(reports.top_anomalies(_bar_scores(spark, sf_dir)))


def _no_anomaly_note(spark: SparkSession, sf_dir: str) -> DataFrame:
    # No window of 20 rows can reach an absolute score of 5.
    return reports.no_anomaly_note(with_zscore(_tick_stats(spark, sf_dir), 5.0))


def _no_anomaly_note_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.no_anomaly_note(with_zscore(_tick_stats(spark, sf_dir), THRESHOLD))


def _appended_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The z-score table after two runs appended to it, and the second run alone."""
    scores = with_zscore(_tick_stats(spark, sf_dir), THRESHOLD)
    stored = zscore_output(scores, WINDOW, THRESHOLD, STAMP).unionByName(
        zscore_output(scores, WINDOW, THRESHOLD, SECOND_STAMP)
    )
    return stored, reports.one_batch(stored, SECOND_STAMP.batch_id)


def _appended_zscore_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(reports.zscore_summary(_appended_runs(spark, sf_dir)[0]))


def _one_batch_zscore_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(reports.zscore_summary(_appended_runs(spark, sf_dir)[1]))


def _overlapping_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The z-score table after two runs over days that overlap; the second warms up within them."""
    ticks = _ticks(spark, sf_dir)
    runs = (
        (history(ticks, None, None, FIRST_RUN_END, columns=None), STAMP),
        (history(ticks, None, SECOND_RUN_START, None, columns=None), SECOND_STAMP),
    )
    first, second = (
        zscore_output(with_zscore(balanced_rolling_stats(t, WINDOW), THRESHOLD), WINDOW, THRESHOLD, stamp)
        for t, stamp in runs
    )
    return first.unionByName(second)


def _latest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(reports.latest_rows(_overlapping_runs(spark, sf_dir)))


def _latest_zscore_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(reports.zscore_summary(reports.latest_rows(_overlapping_runs(spark, sf_dir))))


def _kept(df: DataFrame) -> DataFrame:
    """Computed now, so that the tables it was read from can go."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _over_stored_tables(
    spark: SparkSession, sf_dir: str, report: Callable[[DataFrame, DataFrame], DataFrame]
) -> DataFrame:
    """``report`` over both result tables, stored in buckets by symbol in two appended runs of days."""
    layout = TableLayout(BUCKETS)
    names = [f"tidemark_{kind}_{uuid4().hex}" for kind in ("bands", "scores")]
    try:
        for name, table, rows in zip(names, (BANDS_TABLE, ZSCORE_TABLE), _tick_outputs(spark, sf_dir)):
            create_table(spark, name, table, layout)
            middle = F.lit(START).cast("timestamp_ntz")
            save(rows.where(F.col("BarDateTime") < middle), name)
            save(rows.where(F.col("BarDateTime") >= middle), name)
        return _kept(report(*(spark.table(n) for n in names)))
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _stored_tables_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    def report(bands: DataFrame, scores: DataFrame) -> DataFrame:
        prices, anomalies = reports.price_groups(bands), reports.anomaly_groups(scores)
        return reports.per_symbol_report(prices, anomalies, null_safe=False)

    return _over_stored_tables(spark, sf_dir, report)


def _stored_tables_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows once more over the stored closes, in their stored type."""

    def stats(bands: DataFrame, _: DataFrame) -> DataFrame:
        bars = bands.select("Symbol", "BarDateTime", "ClosePrice")
        return rolling_stats(bars, WINDOW).withColumn("MovingAvg", F.col("MovingAvg").cast("double"))

    return _comparable(_over_stored_tables(spark, sf_dir, stats))


def _stored_tables_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_stored_tables(spark, sf_dir, reports.overall_totals)


def _in_scratch_folder(
    spark: SparkSession, work: Callable[[str], DataFrame]
) -> DataFrame:
    """What ``work`` computes from files that it may write to a folder of its own."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/tables-{uuid4()}"
    try:
        return _kept(work(folder))
    finally:
        remove_folder(spark, folder)


def _overwritten_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The z-score table by days, of which a second run has replaced the later ones."""

    def work(folder: str) -> DataFrame:
        scores = with_zscore(_tick_stats(spark, sf_dir), THRESHOLD)
        first, second = (
            with_bar_day(zscore_output(scores, WINDOW, THRESHOLD, stamp)) for stamp in (STAMP, SECOND_STAMP)
        )
        target = f"{folder}/scores"
        save(first, target, partition_by=("BarDate",))
        late = second.where(F.col("BarDate") >= F.lit(SECOND_RUN_START).cast("date"))
        save(late, target, "overwrite", partition_by=("BarDate",), replace="partitions")
        return spark.read.parquet(target)

    return _comparable(_in_scratch_folder(spark, work))


def _committed_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary of a table that two batches were written to, one of which was never committed."""

    def work(folder: str) -> DataFrame:
        bands, scores = _tick_outputs(spark, sf_dir)
        log = BatchLog(spark, f"{folder}/log")
        outputs = {"bands": (bands, f"{folder}/bands"), "zscores": (scores, f"{folder}/scores")}
        log.store(STAMP.batch_id, outputs)
        log.store(STAMP.batch_id, outputs)
        stray = scores.withColumn("BatchId", F.lit(SECOND_STAMP.batch_id))
        save(stray, f"{folder}/scores", partition_by=("BatchId",))
        return reports.zscore_summary(log.visible(spark.read.parquet(f"{folder}/scores")))

    return _comparable(_in_scratch_folder(spark, work))


def _clean_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    names = (
        part.select(F.col("p_type").alias("raw"))
        .unionByName(part.select(F.col("p_name").alias("raw")))
        .unionByName(_table(spark, sf_dir, "nation").select(F.col("n_name").alias("raw")))
    )
    return SYMBOL_RULE.judged(names, "raw").distinct()


def _symbol_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_symbols(_table(spark, sf_dir, "documents"), "text", "doc_id")


_QUERIES: dict[str, Query] = {
    "history_scan": _history_scan,
    "history_scan_whole_end_day": _history_scan_whole_end_day,
    "moving_stats": _moving_stats,
    "moving_stats_cut": _moving_stats_cut,
    "moving_stats_cut_ties": _moving_stats_cut_ties,
    "moving_stats_cut_text": _moving_stats_cut_text,
    "moving_stats_wide": _moving_stats_wide,
    "moving_stats_wide_cut": _moving_stats_wide_cut,
    "moving_stats_blocks": _moving_stats_blocks,
    "history_in_slices": _history_in_slices,
    "moving_stats_small_window": _moving_stats_small_window,
    "moving_stats_single_row": _moving_stats_single_row,
    "moving_stats_decimal": _moving_stats_decimal,
    "moving_stats_in_range": _moving_stats_in_range,
    "bollinger_bands": _bollinger_bands,
    "zscore_anomalies": _zscore_anomalies,
    "zscore_bars": _zscore_bars,
    "zscore_bars_cut": _zscore_bars_cut,
    "bollinger_output": _bollinger_output,
    "zscore_output": _zscore_output,
    "bollinger_preview": _bollinger_preview,
    "zscore_preview": _zscore_preview,
    "bollinger_summary": _bollinger_summary,
    "zscore_summary": _zscore_summary,
    "top_anomalies": _top_anomalies,
    "top_anomalies_settled": _top_anomalies_settled,
    "top_anomalies_ticks": _top_anomalies_ticks,
    "overall_totals": _overall_totals,
    "overall_totals_one_pass": _overall_totals_one_pass,
    "per_symbol_report": _per_symbol_report,
    "per_symbol_report_one_pass": _per_symbol_report_one_pass,
    "overall_report": _overall_report,
    "top_anomaly_report": _top_anomaly_report,
    "no_anomaly_note": _no_anomaly_note,
    "no_anomaly_note_flagged": _no_anomaly_note_flagged,
    "appended_zscore_summary": _appended_zscore_summary,
    "one_batch_zscore_summary": _one_batch_zscore_summary,
    "latest_scores": _latest_scores,
    "latest_zscore_summary": _latest_zscore_summary,
    "stored_tables_report": _stored_tables_report,
    "stored_tables_stats": _stored_tables_stats,
    "stored_tables_totals": _stored_tables_totals,
    "overwritten_days": _overwritten_days,
    "committed_summary": _committed_summary,
    "clean_symbols": _clean_symbols,
    "symbol_list": _symbol_list,
}


# The text operators are a subpackage of their own that may be left out.
try:
    import corpus_pipeline
    from tidemark.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tidemark.llm", "tidemark.llm.queries"):
        raise
    llm = corpus_pipeline = None


def queries() -> dict[str, Query]:
    if llm is None:
        return dict(_QUERIES)
    return {**_QUERIES, **llm.QUERIES, "pipeline": corpus_pipeline.run}


# --- the same in SQL -------------------------------------------------------------------

_TICK = """
tick AS (
  SELECT 'U' || user_id AS "Symbol", ts AS "BarDateTime", value AS "ClosePrice" FROM events
)"""

_BAR = """
bar AS (
  SELECT upper(event_type) AS "Symbol",
         CAST(date_trunc('hour', ts) AS TIMESTAMP) AS "BarDateTime",
         arg_min(value, (ts, event_id)) AS "OpenPrice", max(value) AS "HighPrice",
         min(value) AS "LowPrice", arg_max(value, (ts, event_id)) AS "ClosePrice",
         count(*) AS "Volume"
  FROM events GROUP BY 1, 2
)"""


def _stats_sql(source: str, n: int = WINDOW, value: str = '"ClosePrice"', where: str = "TRUE") -> str:
    return f"""
numbered AS (
  SELECT "Symbol", "BarDateTime", {value} AS "ClosePrice",
         avg({value}) OVER w AS "MovingAvg",
         stddev_samp({value}) OVER w AS "RollingStd",
         CAST(row_number() OVER (PARTITION BY "Symbol" ORDER BY "BarDateTime") AS INTEGER)
           AS "RowNum"
  FROM {source} WHERE {where}
  WINDOW w AS (PARTITION BY "Symbol" ORDER BY "BarDateTime"
               ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)
),
stats AS (SELECT *, "RowNum" < {n} AS "IsWarmup" FROM numbered)"""


_SIGNALS = f"""
scored AS (
  SELECT *,
         "MovingAvg" + {NUM_STD}::DOUBLE * "RollingStd" AS "UpperBand",
         "MovingAvg" - {NUM_STD}::DOUBLE * "RollingStd" AS "LowerBand",
         CASE WHEN "RollingStd" > 0
              THEN ("ClosePrice" - "MovingAvg") / "RollingStd" END AS "ZScore"
  FROM stats
),
signals AS (
  SELECT *, coalesce(abs("ZScore") >= {THRESHOLD}::DOUBLE, FALSE) AS "IsAnomaly" FROM scored
)"""


def _number(name: str, decimals: int = 6) -> str:
    return f'round("{name}", {decimals}) + 0.0 AS "{name}"'


def _stored(name: str, scale: int = 8, digits: int = 18) -> str:
    return f'CAST("{name}" AS DECIMAL({digits},{scale})) AS "{name}"'


def _stored_sql(stamps: tuple[RunStamp, ...] = (STAMP,)) -> str:
    """Both result tables as stored, all columns in one relation."""
    runs = ", ".join(
        f"('{s.batch_id}', TIMESTAMP '{s.load_date.isoformat(sep=' ')}')" for s in stamps
    )
    return f"""
runs("BatchId", "LoadDate") AS (VALUES {runs}),
stored AS (
  SELECT "Symbol", "BarDateTime", {_stored("ClosePrice", 4)}, {WINDOW} AS "WindowSize",
         CAST({NUM_STD} AS DECIMAL(9,4)) AS "NumStdDev",
         CAST({THRESHOLD} AS DECIMAL(9,4)) AS "ZThreshold",
         {", ".join(_stored(c) for c in ("MovingAvg", "RollingStd", "UpperBand", "LowerBand", "ZScore"))},
         "IsAnomaly", "IsWarmup", "LoadDate", "BatchId"
  FROM signals CROSS JOIN runs
)"""


_SUMMARIES = """
prices AS (
  SELECT "Symbol", count(*) AS "BarCount", min("BarDateTime") AS "MinDate",
         max("BarDateTime") AS "MaxDate",
         CAST(min("ClosePrice") AS DOUBLE) AS "MinClose",
         CAST(max("ClosePrice") AS DOUBLE) AS "MaxClose",
         round(avg("ClosePrice"), 6) AS "AvgClose"
  FROM stored WHERE NOT "IsWarmup" GROUP BY "Symbol"
),
anomalies AS (
  SELECT "Symbol", count(*) AS "BarCount",
         CAST(sum(CASE WHEN "IsAnomaly" THEN 1 ELSE 0 END) AS BIGINT) AS "AnomalyCount",
         CAST(max(abs("ZScore")) AS DOUBLE) AS "MaxAbsZScore"
  FROM stored WHERE NOT "IsWarmup" GROUP BY "Symbol"
),
totals AS (
  SELECT count(DISTINCT "Symbol") AS "SymbolCount", count(*) AS "TotalBollingerRows",
         min("BarDateTime") AS "MinDate", max("BarDateTime") AS "MaxDate",
         count(*) AS "TotalZScoreRows",
         CAST(sum(CASE WHEN "IsAnomaly" THEN 1 ELSE 0 END) AS BIGINT) AS "TotalAnomalies"
  FROM stored WHERE NOT "IsWarmup"
)"""


def _run_sql(name: str, where: str, stamp: RunStamp) -> str:
    """The z-score table as one run over some of the ticks stores it."""
    return f"""
{name} AS (
  WITH {_stats_sql("tick", where=where)}, {_SIGNALS}
  SELECT "Symbol", "BarDateTime", {_stored("ClosePrice", 4)}, {WINDOW} AS "WindowSize",
         {", ".join(_stored(c) for c in ("MovingAvg", "RollingStd", "ZScore"))},
         CAST({THRESHOLD} AS DECIMAL(9,4)) AS "ZThreshold", "IsAnomaly", "IsWarmup",
         TIMESTAMP '{stamp.load_date.isoformat(sep=" ")}' AS "LoadDate", '{stamp.batch_id}' AS "BatchId"
  FROM signals
)"""


def _latest_sql() -> tuple[str, ...]:
    """Of two overlapping runs, the later row of every bar."""
    return (
        _TICK,
        _run_sql("run_1", f"\"BarDateTime\" <= TIMESTAMP '{FIRST_RUN_END}'", STAMP),
        _run_sql("run_2", f"\"BarDateTime\" >= TIMESTAMP '{SECOND_RUN_START}'", SECOND_STAMP),
        """
stored AS (
  SELECT * FROM (SELECT * FROM run_1 UNION ALL SELECT * FROM run_2)
  QUALIFY row_number() OVER (PARTITION BY "Symbol", "BarDateTime", "WindowSize"
                             ORDER BY "LoadDate" DESC, "BatchId" DESC) = 1
)""",
    )


def _note_sql(threshold: float) -> str:
    return f"""
SELECT 'No anomalies flagged in the current data.' AS "Note"
FROM (SELECT count(*) AS flagged FROM signals WHERE abs("ZScore") >= {threshold}) WHERE flagged = 0"""


def _ordered_stats_sql(order: str, expression: str) -> str:
    """Statistics of the ticks in another order, equal places by value."""
    return f"""
WITH tick AS (
  SELECT 'U' || user_id AS "Symbol", {expression} AS "{order}", value AS "ClosePrice" FROM events
),
stats AS (
  SELECT *, avg("ClosePrice") OVER w AS "MovingAvg", stddev_samp("ClosePrice") OVER w AS "RollingStd",
         CAST(row_number() OVER (PARTITION BY "Symbol" ORDER BY "{order}", "ClosePrice") AS INTEGER)
           AS "RowNum"
  FROM tick
  WINDOW w AS (PARTITION BY "Symbol" ORDER BY "{order}", "ClosePrice"
               ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW)
)
SELECT "Symbol", "{order}", {_number("ClosePrice")}, {_number("MovingAvg")}, {_number("RollingStd")},
       "RowNum", "RowNum" < {WINDOW} AS "IsWarmup"
FROM stats"""


def _with(*parts: str, select: str) -> str:
    return f"WITH {','.join(parts)}\n{select}"




def _stats_select(decimals: int = 6) -> str:
    numbers = ", ".join(_number(c, decimals) for c in ("ClosePrice", "MovingAvg", "RollingStd"))
    return f"""
SELECT "Symbol", "BarDateTime", {numbers}, "RowNum", "IsWarmup" FROM stats"""


_STATS_SELECT = _stats_select()

_DECIMAL_STATS_SELECT = _STATS_SELECT.replace(
    _number("ClosePrice"), 'CAST("ClosePrice" AS DOUBLE) AS "ClosePrice"'
)

_BANDS_SELECT = f"""
SELECT "Symbol", "BarDateTime", {_number("ClosePrice")}, {_number("MovingAvg")},
       {_number("RollingStd")}, {_number("UpperBand")}, {_number("LowerBand")}, "IsWarmup"
FROM signals"""

_ZSCORE_SELECT = f"""
SELECT "Symbol", "BarDateTime", {_number("ClosePrice")}, {_number("MovingAvg")},
       {_number("RollingStd")}, {_number("ZScore")}, "IsAnomaly", "IsWarmup"
FROM signals"""


def _doubles(*names: str) -> str:
    return ", ".join(f'CAST("{n}" AS DOUBLE) AS "{n}"' for n in names)


def _top_sql(limit: int, warmup: bool = True) -> str:
    return f"""
best AS (
  SELECT "Symbol", "BarDateTime", CAST("ClosePrice" AS DOUBLE) AS "ClosePrice",
         CAST("ZScore" AS DOUBLE) AS "ZScore"
  FROM stored WHERE "IsAnomaly" {"" if warmup else 'AND NOT "IsWarmup"'}
  ORDER BY abs("ZScore") DESC, "Symbol", "BarDateTime" LIMIT {limit}
)"""


_PREVIEW_ORDER = '\nORDER BY "Symbol", "BarDateTime" LIMIT 50'

_PER_SYMBOL_SELECT = """
SELECT p."Symbol", p."BarCount" AS "Bars",
       coalesce(printf('%.2f', p."MinClose"), '-') AS "Min Close",
       coalesce(printf('%.2f', p."MaxClose"), '-') AS "Max Close",
       coalesce(printf('%.2f', p."AvgClose"), '-') AS "Avg Close",
       coalesce(a."AnomalyCount", 0) AS "Anomalies",
       coalesce(printf('%.2f', a."MaxAbsZScore"), '-') AS "Max |Z|"
FROM prices p LEFT JOIN anomalies a ON p."Symbol" = a."Symbol" """

_OVERALL_SELECT = """
SELECT 'Symbols' AS "Metric", CAST("SymbolCount" AS VARCHAR) AS "Value" FROM totals
UNION ALL
SELECT 'Date range', coalesce(strftime("MinDate", '%Y-%m-%d %H:%M'), '-') || ' → '
                     || coalesce(strftime("MaxDate", '%Y-%m-%d %H:%M'), '-') FROM totals
UNION ALL
SELECT 'Bollinger rows (excl. warmup)', CAST("TotalBollingerRows" AS VARCHAR) FROM totals
UNION ALL
SELECT 'Z-Score rows (excl. warmup)', CAST("TotalZScoreRows" AS VARCHAR) FROM totals
UNION ALL
SELECT 'Anomalies flagged', coalesce(CAST("TotalAnomalies" AS VARCHAR), '-') FROM totals"""

# The characters of white space by number: SQL text shows them poorly.
_WHITE_SPACE_SQL = " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE)


def _strip_sql(value: str) -> str:
    return f"trim({value}, {_WHITE_SPACE_SQL})"


def oracle_sql() -> dict[str, str]:
    sql = _oracle_sql()
    if llm is not None:
        sql |= llm.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql


def _oracle_sql() -> dict[str, str]:
    scores_select = f"""
SELECT "Symbol", "BarDateTime", "WindowSize", "IsAnomaly", "IsWarmup", "LoadDate", "BatchId",
       {_doubles("ClosePrice", "MovingAvg", "RollingStd", "ZScore", "ZThreshold")}
FROM stored"""
    in_range = f"\"BarDateTime\" BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"
    tick_stats = (_TICK, _stats_sql("tick"))
    bar_stats = (_BAR, _stats_sql("bar"))
    tick_stored = (*tick_stats, _SIGNALS, _stored_sql())
    bar_stored = (*bar_stats, _SIGNALS, _stored_sql())
    tick_runs = (*tick_stats, _SIGNALS, _stored_sql((STAMP, SECOND_STAMP)))

    moving_stats = _with(*tick_stats, select=_STATS_SELECT)
    wide = _with(_BAR, _stats_sql("bar", WIDE_WINDOW), select=_stats_select(WIDE_DECIMALS))
    zscore_bars = _with(*bar_stats, _SIGNALS, select=_ZSCORE_SELECT)
    totals = _with(*tick_stored, _SUMMARIES, select="SELECT * FROM totals")
    per_symbol = _with(*tick_stored, _SUMMARIES, select=_PER_SYMBOL_SELECT)

    return {
        "history_scan": _with(
            _BAR,
            select=f"""
SELECT "Symbol", "BarDateTime", {", ".join(_number(f"{c}Price") for c in ("Open", "High", "Low", "Close"))},
       "Volume"
FROM bar WHERE "Symbol" IN ('CLICK', 'ERROR', 'VIEW') AND {in_range}""",
        ),
        "history_scan_whole_end_day": _with(
            _TICK,
            select=f"""
SELECT * FROM tick
WHERE "BarDateTime" >= TIMESTAMP '{START}'
  AND "BarDateTime" < TIMESTAMP '{END}' + INTERVAL 1 DAY""",
        ),
        "moving_stats": moving_stats,
        "moving_stats_cut": moving_stats,
        "moving_stats_cut_ties": _ordered_stats_sql("Day", "CAST(ts AS DATE)"),
        "moving_stats_cut_text": _ordered_stats_sql("Spelled", "strftime(ts, '%Y-%m-%d %H:%M:%S')"),
        "moving_stats_small_window": _with(
            _TICK, _stats_sql("tick", SMALL_WINDOW), select=_STATS_SELECT
        ),
        "moving_stats_single_row": _with(_TICK, _stats_sql("tick", 1), select=_STATS_SELECT),
        "moving_stats_decimal": _with(
            _TICK,
            _stats_sql("tick", value='CAST("ClosePrice" AS DECIMAL(18,4))'),
            select=_DECIMAL_STATS_SELECT,
        ),
        "moving_stats_in_range": _with(
            _TICK, _stats_sql("tick", where=in_range), select=_STATS_SELECT
        ),
        "bollinger_bands": _with(*tick_stats, _SIGNALS, select=_BANDS_SELECT),
        "zscore_anomalies": _with(*tick_stats, _SIGNALS, select=_ZSCORE_SELECT),
        "zscore_bars": zscore_bars,
        "zscore_bars_cut": zscore_bars,
        "bollinger_output": _with(
            *tick_stored,
            select=f"""
SELECT "Symbol", "BarDateTime", "WindowSize", "IsWarmup", "LoadDate", "BatchId",
       {_doubles("ClosePrice", "NumStdDev", "MovingAvg", "RollingStd", "UpperBand", "LowerBand")}
FROM stored""",
        ),
        "zscore_output": _with(*tick_stored, select=scores_select),
        "bollinger_preview": _with(*tick_stats, _SIGNALS, select=_BANDS_SELECT + _PREVIEW_ORDER),
        "zscore_preview": _with(*tick_stats, _SIGNALS, select=_ZSCORE_SELECT + _PREVIEW_ORDER),
        "bollinger_summary": _with(*tick_stored, _SUMMARIES, select="SELECT * FROM prices"),
        "zscore_summary": _with(*tick_stored, _SUMMARIES, select="SELECT * FROM anomalies"),
        "top_anomalies": _with(*bar_stored, _top_sql(15), select="SELECT * FROM best"),
        "top_anomalies_settled": _with(
            *bar_stored, _top_sql(15, warmup=False), select="SELECT * FROM best"
        ),
        "top_anomalies_ticks": _with(*tick_stored, _top_sql(50), select="SELECT * FROM best"),
        "overall_totals": totals,
        "overall_totals_one_pass": totals,
        "per_symbol_report": per_symbol,
        "per_symbol_report_one_pass": per_symbol,
        "overall_report": _with(*tick_stored, _SUMMARIES, select=_OVERALL_SELECT),
        "top_anomaly_report": _with(
            *bar_stored,
            _top_sql(15),
            select="""
SELECT "Symbol", strftime("BarDateTime", '%Y-%m-%d %H:%M') AS "Bar Date/Time",
       printf('%.2f', "ClosePrice") AS "Close Price", printf('%.3f', "ZScore") AS "Z-Score"
FROM best""",
        ),
        "no_anomaly_note": _with(*tick_stats, _SIGNALS, select=_note_sql(5)),
        "no_anomaly_note_flagged": _with(*tick_stats, _SIGNALS, select=_note_sql(THRESHOLD)),
        "appended_zscore_summary": _with(
            *tick_runs, _SUMMARIES, select="SELECT * FROM anomalies"
        ),
        "one_batch_zscore_summary": _with(
            *tick_stored, _SUMMARIES, select="SELECT * FROM anomalies"
        ),
        "moving_stats_wide": wide,
        "moving_stats_wide_cut": wide,
        "moving_stats_blocks": moving_stats,
        "history_in_slices": _with(_TICK, select="SELECT * FROM tick"),
        "latest_scores": _with(*_latest_sql(), select=scores_select),
        "latest_zscore_summary": _with(*_latest_sql(), _SUMMARIES, select="SELECT * FROM anomalies"),
        "stored_tables_report": per_symbol,
        "stored_tables_stats": _with(
            _TICK,
            _stats_sql("tick", value='CAST("ClosePrice" AS DECIMAL(18,4))'),
            select=_DECIMAL_STATS_SELECT,
        ),
        "stored_tables_totals": totals,
        "overwritten_days": _with(
            *tick_runs,
            select=f"""{scores_select.replace("FROM stored", ', CAST("BarDateTime" AS DATE) AS "BarDate" FROM stored')}
WHERE "BatchId" = CASE WHEN CAST("BarDateTime" AS DATE) >= DATE '{SECOND_RUN_START}'
                       THEN '{SECOND_STAMP.batch_id}' ELSE '{STAMP.batch_id}' END""",
        ),
        "committed_summary": _with(*tick_stored, _SUMMARIES, select="SELECT * FROM anomalies"),
        "clean_symbols": f"""
WITH raw AS (
  SELECT p_type AS s FROM part UNION ALL SELECT p_name FROM part UNION ALL SELECT n_name FROM nation
),
cleaned AS (SELECT DISTINCT upper({_strip_sql("s")}) AS "Symbol" FROM raw)
SELECT "Symbol", regexp_matches("Symbol", '^[A-Za-z0-9.\\-]+$') AS "IsValid"
FROM cleaned WHERE "Symbol" <> ''""",
        "symbol_list": f"""
WITH items AS (
  SELECT doc_id, {_strip_sql("unnest(string_split(text, ','))")} AS "Symbol" FROM documents
)
SELECT doc_id, "Symbol" FROM items WHERE "Symbol" <> '' """,
    }
