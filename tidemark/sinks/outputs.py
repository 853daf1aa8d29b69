"""Stamping results with their run and storing them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks.schemas import BANDS_TABLE, ZSCORE_TABLE
from tidemark.sinks.tables import TableLayout, table_layout
from tidemark.sources.jdbc import JdbcTable

SAVE_MODES = ("append", "overwrite")


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class RunStamp:
    """One identity and one UTC load time, shared by everything a run writes."""

    batch_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    load_date: datetime = field(default_factory=_utc_now)


def bands_output(df: DataFrame, n: int, k: float, stamp: RunStamp) -> DataFrame:
    """Rows of the band table in its stored types."""
    return _typed(df, BANDS_TABLE, stamp, WindowSize=n, NumStdDev=float(k))


def zscore_output(df: DataFrame, n: int, threshold: float, stamp: RunStamp) -> DataFrame:
    """Rows of the z-score table in its stored types."""
    return _typed(df, ZSCORE_TABLE, stamp, WindowSize=n, ZThreshold=float(threshold))


def _typed(df: DataFrame, table: T.StructType, stamp: RunStamp, **parameters) -> DataFrame:
    literals = parameters | {"BatchId": stamp.batch_id}
    columns = []
    for target in table.fields:
        if target.name == "LoadDate":
            column = F.lit(stamp.load_date.isoformat(sep=" "))
        elif target.name in literals:
            column = F.lit(literals[target.name])
        else:
            column = F.col(target.name)
        columns.append(column.cast(target.dataType).alias(target.name))
    return df.select(*columns)


def require_values(df: DataFrame, table: T.StructType) -> DataFrame:
    """Fail on a missing value in a mandatory column, as a database would.

    Meant for the last step before a write: a checked key is a new column to the
    optimizer, so aggregations after it could not reuse the partitioning by symbol.
    """
    return df.select(*[_required(target) for target in table.fields])


def _required(target: T.StructField) -> Column:
    if target.nullable:
        return F.col(target.name)
    message = F.lit(f"{target.name} must not be null")
    return F.coalesce(F.col(target.name), F.raise_error(message)).alias(target.name)


def with_bar_day(df: DataFrame, time: str = "BarDateTime", day: str = "BarDate") -> DataFrame:
    """Append the day of a bar, to store a table by days."""
    return df.withColumn(day, F.to_date(time))


def save(
    df: DataFrame,
    target: JdbcTable | str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    max_records_per_file: int | None = None,
    *,
    layout: TableLayout | None = None,
    replace: str = "all",
) -> int:
    """Write ``df`` and return the number of rows written.

    The count is taken while the rows pass by, so the plan runs once and nothing has to
    be cached. ``target`` is a JDBC table, a catalog table name or a parquet path.
    Overwriting an existing table replaces its rows and keeps its definition; a
    ``partition_by`` that differs from the table's own is refused. With ``replace="partitions"``
    overwriting replaces only the partitions that ``df`` has rows of, and no file of the others
    is touched.

    A catalog table keeps the layout it was created with. ``layout`` gives that of a new table or
    of a path (where it can have no buckets); it costs an exchange before the write.

    File targets commit as a whole. A database commits each task on its own, so a task
    that is run again after its commit can repeat rows there; the batch id identifies them.
    """
    if mode not in SAVE_MODES:
        raise ValueError(f"mode must be one of {', '.join(SAVE_MODES)}, got {mode!r}")
    if replace not in ("all", "partitions"):
        raise ValueError(f"replace must be all or partitions, got {replace!r}")
    by_partition = replace == "partitions" and mode == "overwrite"
    spark, rows = df.sparkSession, Observation()
    count = F.count(F.lit(1)).alias("rows")
    if isinstance(target, JdbcTable):
        if by_partition or layout is not None:
            raise ValueError(f"{target.table}: a database table has neither partitions nor a layout here")
        writer = df.observe(rows, count).write.mode(mode)
        writer.format("jdbc").options(**target.write_options(mode)).save()
        return rows.get["rows"]

    is_path = "/" in target
    stored = None if is_path or not spark.catalog.tableExists(target) else table_layout(spark, target)
    partitions = tuple(partition_by) or (layout.partition_by if layout else ()) or (stored.partition_by if stored else ())
    if stored is not None and mode == "overwrite" and partitions != stored.partition_by:
        raise ValueError(f"{target} is partitioned by {stored.partition_by}, not by {partitions}")
    if by_partition and not partitions:
        raise ValueError(f"{target} has no partitions to replace")
    if is_path and layout is not None and layout.buckets is not None:
        raise ValueError(f"{target}: only catalog tables have buckets")
    wanted = stored if stored is not None and stored.buckets is not None else layout
    # Counted behind the exchange: a sort by ranges runs what is before it twice.
    arranged = (wanted.arranged(df) if wanted is not None else df).observe(rows, count)
    with _setting(spark, "spark.sql.files.maxRecordsPerFile", max_records_per_file):
        if is_path:
            writer = arranged.write.mode(mode).partitionBy(*partitions)
            if by_partition:
                writer = writer.option("partitionOverwriteMode", "dynamic")
            writer.parquet(target)
        elif stored is not None and (mode == "overwrite" or stored.buckets is not None):
            names = [c.name for c in spark.catalog.listColumns(target)]
            if set(names) != set(df.columns):
                raise ValueError(f"{target} has the columns {names}, not {df.columns}")
            with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic" if by_partition else "static"):
                arranged.select(*names).write.insertInto(target, overwrite=mode == "overwrite")
        else:
            writer = arranged.write.mode(mode).format("parquet").partitionBy(*partitions)
            (layout.bucketed(writer) if layout else writer).saveAsTable(target)
    return rows.get["rows"]


@contextmanager
def _setting(spark: SparkSession, name: str, value: str | int | None) -> Iterator[None]:
    """A setting for the time of a write; inserting into a table takes no options."""
    if not value:
        yield
        return
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)
