from datetime import datetime, timezone
from decimal import Decimal

import pytest
from conftest import T0

from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter
from tidemark.operators import rolling_stats, with_bands, with_zscore
from tidemark.sinks import (
    BANDS_TABLE,
    ZSCORE_TABLE,
    RunStamp,
    bands_output,
    create_table,
    require_values,
    save,
    zscore_output,
)
from tidemark.sources import JdbcTable

STAMP = RunStamp("batch-1", datetime(2024, 1, 2, 3, 4, 5, 678901))


@pytest.fixture
def bands(make_bars):
    stats = rolling_stats(make_bars(A=[1.0, 2.0, 3.0, 4.0, 10.0]), 3)
    return bands_output(with_bands(stats, 2.0), 3, 2.0, STAMP)


@pytest.fixture
def scores(make_bars):
    stats = rolling_stats(make_bars(A=[1.0, 2.0, 3.0, 4.0, 10.0]), 3)
    return zscore_output(with_zscore(stats, 1.1), 3, 1.1, STAMP)


def types(schema):
    return [(f.name, f.dataType) for f in schema]


def test_output_types_and_values(bands, scores):
    assert types(bands.schema) == types(BANDS_TABLE)
    assert types(scores.schema) == types(ZSCORE_TABLE)
    last = bands.orderBy("BarDateTime").collect()[-1]
    assert (last.MovingAvg, last.UpperBand) == (Decimal("5.66666667"), Decimal("13.23854446"))
    assert (last.ClosePrice, last.WindowSize, last.NumStdDev) == (Decimal("10.0000"), 3, Decimal("2.0000"))
    assert (last.LoadDate, last.BatchId) == (STAMP.load_date, "batch-1")
    first = scores.orderBy("BarDateTime").first()
    assert (first.ZScore, first.IsAnomaly, first.IsWarmup) == (None, False, True)


def test_values_out_of_range_fail_loudly(make_bars):
    stats = with_bands(rolling_stats(make_bars(A=[1e14, 2e14]), 2), 2.0)
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        bands_output(stats, 2, 2.0, STAMP).collect()


def test_stamps_are_unique_and_in_utc():
    a, b = RunStamp(), RunStamp()
    assert a.batch_id != b.batch_id and len(a.batch_id) == 36
    assert a.load_date.tzinfo is None
    assert abs((a.load_date - datetime.now(timezone.utc).replace(tzinfo=None)).total_seconds()) < 60


def test_append_accumulates_and_overwrite_replaces(spark, bands, tmp_path):
    path = str(tmp_path / "bands")
    assert save(bands, path) == 5
    assert save(bands, path) == 5
    stored = spark.read.parquet(path)
    assert stored.count() == 10
    assert stored.exceptAll(bands.unionByName(bands)).isEmpty()
    assert save(bands.limit(2), path, "overwrite") == 2
    assert spark.read.parquet(path).count() == 2


@pytest.mark.parametrize("mode", ["replace", "ignore", "error", ""])
def test_other_modes_are_refused(bands, tmp_path, mode):
    with pytest.raises(ValueError, match="append, overwrite"):
        save(bands, str(tmp_path / "x"), mode)


def test_catalog_tables(spark, scores):
    create_table(spark, "scores_table", ZSCORE_TABLE)
    create_table(spark, "scores_table", ZSCORE_TABLE)
    assert types(spark.table("scores_table").schema) == types(ZSCORE_TABLE)
    assert save(scores, "scores_table") == 5
    assert save(scores, "scores_table") == 5
    assert spark.table("scores_table").count() == 10
    # Overwriting keeps the definition, whatever the order of the columns.
    reordered = scores.select(*reversed(scores.columns)).where("IsAnomaly")
    assert save(reordered, "scores_table", "overwrite") == 1
    assert types(spark.table("scores_table").schema) == types(ZSCORE_TABLE)
    assert spark.table("scores_table").first().ClosePrice == Decimal("10.0000")


def test_partitioned_and_limited_files(spark, bands, tmp_path):
    path = str(tmp_path / "bands")
    assert save(bands, path, partition_by=["BatchId"], max_records_per_file=2) == 5
    stored = spark.read.parquet(path)
    assert len(stored.inputFiles()) >= 3
    assert all("BatchId=batch-1" in f for f in stored.inputFiles())


def test_overwriting_a_table_keeps_the_file_limit_and_the_partitions(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "id % 2 AS part").repartition(1)
    save(rows, "limited_table", partition_by=["part"])
    before = spark.conf.get("spark.sql.files.maxRecordsPerFile")
    assert save(rows, "limited_table", "overwrite", max_records_per_file=10) == 1000
    assert len(spark.table("limited_table").inputFiles()) == 100
    assert spark.conf.get("spark.sql.files.maxRecordsPerFile") == before
    save(rows, "limited_table", "overwrite", partition_by=["part"])
    assert len(spark.table("limited_table").inputFiles()) == 2
    with pytest.raises(ValueError, match="partitioned by"):
        save(rows, "limited_table", "overwrite", partition_by=["id"])


def test_mandatory_columns(spark, bands, tmp_path):
    assert require_values(bands, BANDS_TABLE).count() == 5
    broken = bands.withColumn("Symbol", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="Symbol must not be null"):
        save(require_values(broken, BANDS_TABLE), str(tmp_path / "x"))


def test_failed_write_leaves_no_rows(spark, bands, tmp_path):
    path = str(tmp_path / "bands")
    save(bands, path)
    broken = bands.withColumn(
        "Symbol", F.when(F.col("BarDateTime") == F.lit(T0), F.lit("A"))
    )
    with pytest.raises(Exception, match="Symbol must not be null"):
        save(require_values(broken, BANDS_TABLE), path)
    assert spark.read.parquet(path).count() == 5


def test_jdbc_write_options(bands, monkeypatch):
    """No database here: the writer is replaced where it would connect."""
    seen = {}
    real = DataFrameWriter.options
    monkeypatch.setattr(DataFrameWriter, "options", lambda s, **o: seen.update(o) or real(s, **o))

    def fake_save(self, *args, **kwargs):
        self.format("noop").mode("overwrite")
        real_save(self)

    real_save = DataFrameWriter.save
    monkeypatch.setattr(DataFrameWriter, "save", fake_save)
    assert save(bands, JdbcTable("jdbc:x", "dbo.Bands", "me", "pw"), "overwrite") == 5
    assert seen["dbtable"] == "dbo.Bands" and seen["truncate"] == "true"


@pytest.mark.parametrize("condition", ["false", "ClosePrice < 0"])
def test_empty_frames_are_written_and_counted(spark, bands, tmp_path, condition):
    path = str(tmp_path / "bands")
    assert save(bands.where(condition), path) == 0
    assert types(spark.read.parquet(path).schema) == types(BANDS_TABLE)
