import pytest
from conftest import SF_SMALL

from tidemark.operators import rolling_stats, with_bands, with_zscore
from tidemark.plans import RunParams, build_report, run
from tidemark.plans import job
from tidemark.sinks import BANDS_COLUMNS, BANDS_TABLE, ZSCORE_COLUMNS, ZSCORE_TABLE
from tidemark.sources import JdbcTable, history
from tidemark.sources.views import hourly_bars

SYMBOLS = ("click", "VIEW", "error")
PARAMS = dict(symbols=SYMBOLS, start="2024-01-03", end="2024-01-25")


@pytest.fixture(scope="module")
def stored_bars(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bars") / "bars.parquet")
    hourly_bars(spark.read.parquet(f"{SF_SMALL}/events.parquet")).write.parquet(path)
    return path


@pytest.fixture
def whole(spark, stored_bars):
    bars = history(spark.read.parquet(stored_bars), SYMBOLS, "2024-01-03", "2024-01-25")
    return rolling_stats(bars, 20)


def test_defaults_and_checks():
    params = RunParams(**PARAMS)
    assert (params.window, params.num_std, params.z_threshold) == (20, 2.0, 2.0)
    assert (params.write_back, params.write_mode) == (False, "append")
    assert params.symbols == ("CLICK", "VIEW", "ERROR")
    for wrong in (
        {"symbols": ()},
        {"symbols": ("a b",)},
        {"start": "now"},
        {"window": 0},
        {"write_mode": "replace"},
        {"reuse": "luck"},
    ):
        with pytest.raises(ValueError):
            RunParams(**(PARAMS | wrong))


def test_preview_run_writes_nothing(spark, stored_bars, whole, capsys):
    result = run(spark, RunParams(**PARAMS), stored_bars)
    assert result.batch_id is None
    order = ["Symbol", "BarDateTime"]
    bands = with_bands(whole, 2.0).select(*BANDS_COLUMNS).orderBy(*order).limit(50)
    scores = with_zscore(whole, 2.0).select(*ZSCORE_COLUMNS).orderBy(*order).limit(50)
    assert result.bands_preview.collect() == bands.collect()
    assert result.zscore_preview.collect() == scores.collect()
    result.show()
    printed = capsys.readouterr().out
    assert "=== BOLLINGER BANDS ===" in printed and "=== Z-SCORE ANOMALIES ===" in printed


def test_write_back_needs_targets(spark, stored_bars):
    with pytest.raises(ValueError, match="target"):
        run(spark, RunParams(**PARAMS, write_back=True), stored_bars)


@pytest.mark.parametrize("reuse", ["persist", "checkpoint"])
def test_write_back_and_report(spark, stored_bars, whole, tmp_path, reuse):
    bands_path, scores_path = str(tmp_path / "bands"), str(tmp_path / "scores")
    params = RunParams(**PARAMS, write_back=True, reuse=reuse)
    first = run(spark, params, stored_bars, bands_path, scores_path)
    n = whole.count()
    assert (first.bands_rows, first.zscore_rows) == (n, n)
    bands, scores = spark.read.parquet(bands_path), spark.read.parquet(scores_path)
    assert bands.columns == BANDS_TABLE.names and scores.columns == ZSCORE_TABLE.names
    # One identity and one load time for both tables.
    stamps = bands.select("BatchId", "LoadDate").union(scores.select("BatchId", "LoadDate"))
    assert [r.BatchId for r in stamps.distinct().collect()] == [first.batch_id]
    flagged = with_zscore(whole, 2.0).where("IsAnomaly").count()
    assert scores.where("IsAnomaly").count() == flagged > 0

    second = run(spark, params, stored_bars, bands_path, scores_path)
    everything = build_report(spark, bands_path, scores_path)
    latest = build_report(spark, bands_path, scores_path, batch_id=second.batch_id)
    settled = whole.where("NOT IsWarmup").count()
    for report, times in ((everything, 2), (latest, 1)):
        values = {r.Metric: r.Value for r in report.overall.collect()}
        assert values["Bollinger rows (excl. warmup)"] == str(times * settled)
        assert [r.Symbol for r in report.per_symbol.collect()] == ["CLICK", "ERROR", "VIEW"]
        assert report.top_anomalies.count() == min(15, times * flagged)
        assert report.no_anomaly_note.isEmpty()

    again = RunParams(**PARAMS, write_back=True, write_mode="overwrite", reuse=reuse)
    run(spark, again, stored_bars, bands_path, scores_path)
    assert spark.read.parquet(bands_path).count() == n


def test_a_run_that_stores_reads_its_source_once(spark, stored_bars, tmp_path, monkeypatch):
    counted = spark.sparkContext.accumulator(0)

    def watched(session, source, *args, **options):
        history = real(session, source, *args, **options)

        def passing(batches):
            for batch in batches:
                counted.add(batch.num_rows)
                yield batch

        return history.mapInArrow(passing, history.schema)

    real = job.read_history
    monkeypatch.setattr(job, "read_history", watched)
    result = run(spark, RunParams(**PARAMS, write_back=True), stored_bars, str(tmp_path / "b"), str(tmp_path / "z"))
    assert counted.value == result.bands_rows > 0
    assert result.bands_preview.count() == 50 and counted.value == result.bands_rows


def test_stored_database_tables_are_read_once_in_slices(spark, stored_bars, whole, tmp_path, monkeypatch):
    """No database here: the reader is replaced where it would connect."""
    bands_path, scores_path = str(tmp_path / "b"), str(tmp_path / "z")
    run(spark, RunParams(**PARAMS, write_back=True), stored_bars, bands_path, scores_path)
    loads = []

    def fake(session, source):
        loads.append(source.read_options())
        return session.read.parquet(bands_path if source.table == "b" else scores_path)

    monkeypatch.setattr(job, "read_table", fake)
    tables = [JdbcTable("jdbc:x", t, connections=4, slices=("Id", "1", "9")) for t in "bz"]
    report = build_report(spark, *tables)
    assert [r.Symbol for r in report.per_symbol.collect()] == ["CLICK", "ERROR", "VIEW"]
    assert report.no_anomaly_note.isEmpty() and report.top_anomalies.count() == 15
    assert [o["numPartitions"] for o in loads] == ["4", "4"]


def test_nothing_stays_cached(spark, stored_bars, tmp_path):
    params = RunParams(**PARAMS, write_back=True)
    with pytest.raises(Exception):
        run(spark, params, stored_bars, str(tmp_path / "a"), "no such database.table")
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == 0


def test_signals_hold_both_results(spark, stored_bars, whole):
    bars = history(spark.read.parquet(stored_bars), SYMBOLS, "2024-01-03", "2024-01-25")
    both = job.signals(bars, RunParams(**PARAMS))
    assert both.select(*ZSCORE_COLUMNS).exceptAll(
        with_zscore(whole, 2.0).select(*ZSCORE_COLUMNS)
    ).isEmpty()
    assert set(BANDS_COLUMNS) <= set(both.columns)


def test_empty_range_writes_no_rows(spark, stored_bars, tmp_path):
    params = RunParams(SYMBOLS, "2030-01-01", "2030-02-01", write_back=True)
    result = run(spark, params, stored_bars, str(tmp_path / "b"), str(tmp_path / "z"))
    assert (result.bands_rows, result.zscore_rows) == (0, 0)
    assert result.bands_preview.isEmpty()
    report = build_report(spark, str(tmp_path / "b"), str(tmp_path / "z"))
    assert report.no_anomaly_note.count() == 1 and report.per_symbol.isEmpty()
