"""How the rows of a stored table lie in its files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.series import BARS, SeriesSpec

# Rows that one bucket file should hold: what a task sorts in seconds.
ROWS_PER_BUCKET = 5_000_000
# A series of more buckets than this would make one task of every window and summary too long.
MOST_BUCKETS_OF_A_SERIES = 4


@dataclass(frozen=True)
class TableLayout:
    """Order in place of an index on (key, time).

    With ``buckets``, all rows of a series are in one bucket, sorted by ``sorted_by``: windows,
    summaries and joins by the key need no exchange, and a filter on one key opens one bucket. Only
    catalog tables have buckets. Without, rows are dealt to files by ranges of ``sorted_by``, which
    lets filters skip files and row groups and divides series of any length among files.
    """

    buckets: int | None = None
    key: str = BARS.keys[0]
    sorted_by: tuple[str, ...] = (*BARS.keys, BARS.order)
    partition_by: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.buckets is not None and self.buckets < 1:
            raise ValueError(f"buckets must be at least 1, got {self.buckets}")

    def bucketed(self, writer: DataFrameWriter) -> DataFrameWriter:
        """The writer of a new table, told of its buckets."""
        if self.buckets is None:
            return writer
        writer = writer.bucketBy(self.buckets, self.key)
        return writer.sortBy(*self.sorted_by) if self.sorted_by else writer

    def arranged(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` dealt to tasks as they go to files: one task per bucket or range."""
        if self.buckets is not None:
            return df.repartition(self.buckets, F.col(self.key))
        if not self.sorted_by:
            return df
        order = [F.col(c) for c in (*self.partition_by, *self.sorted_by)]
        return df.repartitionByRange(*order).sortWithinPartitions(*order)


def plan_table_layout(
    df: DataFrame,
    spec: SeriesSpec = BARS,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    partition_by: tuple[str, ...] = (),
) -> TableLayout:
    """Buckets for a table of this size, or ranges where one series is too long for a bucket.

    One aggregation over the key column decides.
    """
    if rows_per_bucket < 1:
        raise ValueError(f"rows_per_bucket must be at least 1, got {rows_per_bucket}")
    key = spec.keys[0]
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total, longest = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0)), F.coalesce(F.max("_rows"), F.lit(0))).first()
    order = (*spec.keys, spec.order)
    if longest > MOST_BUCKETS_OF_A_SERIES * rows_per_bucket:
        return TableLayout(None, key, order, partition_by)
    return TableLayout(max(1, -(-total // rows_per_bucket)), key, order, partition_by)


def table_layout(spark: SparkSession, name: str) -> TableLayout:
    """The layout that a catalog table was created with."""
    columns = spark.catalog.listColumns(name)
    partition_by = tuple(c.name for c in columns if c.isPartition)
    keys = [c.name for c in columns if c.isBucket]
    if not keys:
        return TableLayout(None, sorted_by=(), partition_by=partition_by)
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    order = tuple(c.strip(" `") for c in told.get("Sort Columns", "[]").strip("[]").split(",") if c.strip())
    return TableLayout(int(told["Num Buckets"]), keys[0], order, partition_by)


def create_table(spark: SparkSession, name: str, table: T.StructType, layout: TableLayout | None = None) -> None:
    """Create an empty parquet table unless it is there already."""
    if spark.catalog.tableExists(name):
        return
    layout = layout or TableLayout(sorted_by=())
    writer = spark.createDataFrame([], table).write.format("parquet").mode("ignore")
    layout.bucketed(writer.partitionBy(*layout.partition_by)).saveAsTable(name)
