"""The analytics run: read, compute, preview and optionally store."""

from __future__ import annotations

import logging
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.symbols import SYMBOLS
from tidemark.operators import (
    balanced_rolling_stats,
    leading_rolling_stats,
    with_bands,
    with_signals,
    with_zscore,
)
from tidemark.plans import reports
from tidemark.scratch import ensure_checkpoint_dir, staged
from tidemark.series import BARS
from tidemark.sinks import (
    BANDS_COLUMNS,
    BANDS_TABLE,
    ZSCORE_COLUMNS,
    ZSCORE_TABLE,
    BatchLog,
    RunStamp,
    bands_output,
    require_values,
    save,
    zscore_output,
)
from tidemark.sinks.outputs import SAVE_MODES
from tidemark.sources import JdbcTable, day_range, read_history, read_table

log = logging.getLogger(__name__)

# What a preview shows.
PREVIEW_ROWS = 50
BANDS_TITLE = "BOLLINGER BANDS"
ZSCORE_TITLE = "Z-SCORE ANOMALIES"


@dataclass(frozen=True)
class RunParams:
    """What to compute. ``reuse`` says how the history is kept while it is used twice.

    ``persist`` keeps it in executor storage and reads again what is lost with an
    executor; ``checkpoint`` writes it to the shared folder first, which is worth it
    where executors come and go.
    """

    symbols: tuple[str, ...]
    start: str
    end: str
    window: int = 20
    num_std: float = 2.0
    z_threshold: float = 2.0
    write_back: bool = False
    write_mode: str = "append"
    reuse: str = "persist"

    def __post_init__(self) -> None:
        object.__setattr__(self, "symbols", SYMBOLS.require(self.symbols))
        day_range(self.start, self.end)
        if self.window < 1:
            raise ValueError(f"window must be at least 1, got {self.window}")
        if self.write_mode not in SAVE_MODES:
            raise ValueError(f"write_mode must be one of {SAVE_MODES}, got {self.write_mode!r}")
        if self.reuse not in ("persist", "checkpoint"):
            raise ValueError(f"reuse must be persist or checkpoint, got {self.reuse!r}")


@dataclass(frozen=True)
class RunResult:
    """Two previews, and what was stored if anything was."""

    bands_preview: DataFrame
    zscore_preview: DataFrame
    batch_id: str | None = None
    bands_rows: int = 0
    zscore_rows: int = 0

    def show(self) -> None:
        for title, preview in (
            (BANDS_TITLE, self.bands_preview),
            (ZSCORE_TITLE, self.zscore_preview),
        ):
            print(f"\n=== {title} ===")
            preview.show(PREVIEW_ROWS, truncate=False)


def bands_preview(history: DataFrame, n: int, k: float, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows of the bands in (symbol, time) order."""
    stats = leading_rolling_stats(history.select(*BARS.columns), n, rows)
    return with_bands(stats, k).select(*BANDS_COLUMNS)


def zscore_preview(
    history: DataFrame, n: int, threshold: float, rows: int = PREVIEW_ROWS
) -> DataFrame:
    """The first rows of the z-scores in (symbol, time) order."""
    stats = leading_rolling_stats(history.select(*BARS.columns), n, rows)
    return with_zscore(stats, threshold).select(*ZSCORE_COLUMNS)


def run(
    spark: SparkSession,
    params: RunParams,
    source: JdbcTable | str,
    bands_target: JdbcTable | str | None = None,
    zscore_target: JdbcTable | str | None = None,
    batch_log: str | None = None,
    batch_id: str | None = None,
) -> RunResult:
    """Compute bands and z-scores of the chosen series; store them if asked to.

    A run that stores reads its source once and computes its windows once: the history is kept
    while its long series are measured, the statistics are written to the shared folder with both
    results side by side, and each target is a projection of those files.

    With ``batch_log``, the folder of a `BatchLog`, both results are committed together, and a
    ``batch_id`` that is committed already is not computed again.
    """
    history = read_history(
        spark, source, params.symbols, params.start, params.end, columns=BARS.columns
    )
    if not params.write_back:
        return RunResult(*_previews(history, params))
    if bands_target is None or zscore_target is None:
        raise ValueError("write_back needs a target for the bands and one for the z-scores")
    if batch_log is not None and params.write_mode != "append":
        raise ValueError("a batch log is for tables that runs are appended to")

    stamp = RunStamp() if batch_id is None else RunStamp(batch_id)
    log_of_batches = None if batch_log is None else BatchLog(spark, batch_log)
    known = None if log_of_batches is None else log_of_batches.outputs(stamp.batch_id)
    if known is not None:
        return RunResult(*_previews(history, params), stamp.batch_id, known["bands"], known["zscores"])
    with ExitStack() as stages:
        with shared(history, params.reuse) as kept:
            both = stages.enter_context(staged(signals(kept, params).drop("RowNum")))
        bands = bands_output(both, params.window, params.num_std, stamp)
        scores = zscore_output(both, params.window, params.z_threshold, stamp)
        bands, scores = require_values(bands, BANDS_TABLE), require_values(scores, ZSCORE_TABLE)
        if log_of_batches is None:
            bands_rows = save(bands, bands_target, params.write_mode)
            zscore_rows = save(scores, zscore_target, params.write_mode)
        else:
            written = log_of_batches.store(
                stamp.batch_id, {"bands": (bands, bands_target), "zscores": (scores, zscore_target)}
            )
            bands_rows, zscore_rows = written["bands"], written["zscores"]
        # Fifty rows each, held as values because the files go.
        first = both.orderBy(*_first_rows()).limit(PREVIEW_ROWS)
        previews = [
            spark.createDataFrame(p.collect(), p.schema)
            for p in (first.select(*BANDS_COLUMNS), first.select(*ZSCORE_COLUMNS))
        ]
    log.info("batch %s: %d band rows, %d z-score rows", stamp.batch_id, bands_rows, zscore_rows)
    return RunResult(*previews, stamp.batch_id, bands_rows, zscore_rows)


def _first_rows() -> list[Column]:
    return [*(F.col(k).asc_nulls_first() for k in BARS.keys), *BARS.ascending()]


def _previews(history: DataFrame, params: RunParams) -> tuple[DataFrame, DataFrame]:
    return (
        bands_preview(history, params.window, params.num_std),
        zscore_preview(history, params.window, params.z_threshold),
    )


@contextmanager
def shared(df: DataFrame, reuse: str) -> Iterator[DataFrame]:
    """``df`` computed once for several consumers."""
    if reuse == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        yield df.checkpoint()
        return
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def signals(history: DataFrame, params: RunParams) -> DataFrame:
    """Statistics, bands and z-scores of a history in one frame."""
    stats = balanced_rolling_stats(history.select(*BARS.columns), params.window)
    return with_signals(stats, params.num_std, params.z_threshold)


@dataclass(frozen=True)
class Report:
    """The frames of the summary report."""

    overall: DataFrame
    per_symbol: DataFrame
    top_anomalies: DataFrame
    no_anomaly_note: DataFrame


def build_report(
    spark: SparkSession,
    bands_source: JdbcTable | str,
    zscore_source: JdbcTable | str,
    top: int = reports.DEFAULT_TOP,
    batch_id: str | None = None,
    batch_log: str | None = None,
    latest: bool = False,
) -> Report:
    """The summary report over stored results, of all runs or of one.

    With ``batch_log`` only batches that were stored completely are seen. With ``latest`` runs that
    overlap are resolved first (`reports.latest_rows`).

    Four frames read these tables. What they need of a database table is therefore fetched once,
    by its own connections, and kept in the shared folder.
    """
    bands, scores = read_table(spark, bands_source), read_table(spark, zscore_source)
    if batch_id is not None:
        bands, scores = reports.one_batch(bands, batch_id), reports.one_batch(scores, batch_id)
    if batch_log is not None:
        done = BatchLog(spark, batch_log)
        bands, scores = done.visible(bands), done.visible(scores)
    if latest:
        bands, scores = reports.latest_rows(bands), reports.latest_rows(scores)
    bands = bands.select("Symbol", "BarDateTime", "ClosePrice", "IsWarmup")
    scores = scores.select("Symbol", "BarDateTime", "ClosePrice", "ZScore", "IsAnomaly", "IsWarmup")
    ensure_checkpoint_dir(spark)
    if isinstance(bands_source, JdbcTable):
        bands = bands.checkpoint()
    if isinstance(zscore_source, JdbcTable):
        scores = scores.checkpoint()
    return Report(
        overall=reports.overall_report(reports.overall_totals(bands, scores)),
        per_symbol=reports.per_symbol_report(
            reports.price_groups(bands), reports.anomaly_groups(scores), null_safe=False
        ),
        top_anomalies=reports.top_anomaly_report(reports.top_anomalies(scores, top)),
        no_anomaly_note=reports.no_anomaly_note(scores),
    )
