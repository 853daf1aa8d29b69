"""Long series in pieces, so that no task has to hold one whole.

A window function sends all rows of a series to one task. When one symbol holds a large share
of the table that task decides the run time. A layout takes such series aside: their rows are
sorted once over all tasks by the columns that order a series (Spark samples splitters and
compares the values themselves, whatever their types), numbered, and kept in the shared folder.
The number of a row in its series then says which pieces of bounded size need it.

Rows that agree in every ordering column may stand in any order; they are dealt out at random,
so that many equal rows do not meet in one task either.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scratch import ensure_checkpoint_dir
from tidemark.series import BARS, SeriesSpec

# Below this many rows a series is never worth cutting: one task sorts them in seconds.
MIN_ROWS_PER_TASK = 5_000_000

# Tables of keys up to this size, measured, are sent to every task; larger ones are joined.
MAX_BROADCAST_BYTES = 8 << 20

ROW = "_row"
CELL = "_cell"
_PLACE, _TASK, _TIE = "_place", "_task", "_tie"
# `monotonically_increasing_id` counts the rows of a task in the lower 33 bits.
_TASK_BITS = 33


@dataclass(frozen=True)
class SeriesLayout:
    """The long series of one table and their rows; other series stay whole.

    ``rows`` are all rows of the long series as they were when the layout was made, with their
    place in one common order.
    """

    spec: SeriesSpec
    long: DataFrame | None = None
    rows: DataFrame | None = None
    rows_per_piece: int = 0
    is_small: bool = True

    @property
    def is_split(self) -> bool:
        return self.rows is not None

    def whole(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` whose series are not cut."""
        return _join(df, self.long.drop("_rows"), self.spec.keys, "left_anti", self.is_small)

    def numbered(self) -> DataFrame:
        """The rows of the cut series with their number from 1 on and their series' length."""
        keys = list(self.spec.keys)
        rows = self.rows.withColumn(_TASK, F.shiftright(_PLACE, _TASK_BITS))
        parts = rows.groupBy(*keys, _TASK).agg(
            F.count(F.lit(1)).alias("_rows"), F.min(_PLACE).alias("_first")
        )
        series = Window.partitionBy(*keys)
        earlier = series.orderBy(_TASK).rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.select(
            *keys,
            _TASK,
            (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
            F.sum("_rows").over(series).alias("_length"),
        )
        joined = _join(rows, parts, [*keys, _TASK], "inner", self.is_small)
        return joined.withColumn(ROW, F.col(_PLACE) + F.col("_shift")).drop(_PLACE, _TASK, "_shift")

    def in_pieces(self, lead: int) -> DataFrame:
        """Every row once per piece that needs it: its own, and later ones that begin within
        ``lead`` rows after it."""
        size = F.lit(self.rows_per_piece)
        own = F.call_function("div", F.col(ROW) - 1, size)
        last = F.call_function("div", F.least(F.col("_length"), F.col(ROW) + lead) - 1, size)
        return self.numbered().withColumn(CELL, F.explode(F.sequence(own, last))).drop("_length")

    def is_own(self) -> Column:
        """Whether a row stands in its own piece, and not as lead-in of a later one."""
        return F.col(CELL) == F.call_function("div", F.col(ROW) - 1, F.lit(self.rows_per_piece))


def plan_layout(
    df: DataFrame, spec: SeriesSpec = BARS, rows_per_task: int | None = None
) -> SeriesLayout:
    """Measure the series of ``df`` and take the long ones aside.

    A series is long when it has more than ``rows_per_task`` rows. The default is a fair share
    of the table: its row count divided by the shuffle partitions, at least
    `MIN_ROWS_PER_TASK`. Cutting changes how a series is computed and never what comes out.

    The first pass reads the key columns only. If nothing is long it is the only one.
    """
    if rows_per_task is not None and rows_per_task < 1:
        raise ValueError(f"rows_per_task must be at least 1, got {rows_per_task}")
    spark, keys = df.sparkSession, list(spec.keys)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    limit = rows_per_task or MIN_ROWS_PER_TASK
    # Everything that decides comes from one pass; the long keys are only kept if there are any.
    total, longest = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0)), F.max("_rows")).first()
    if rows_per_task is None:
        limit = max(limit, -(-total // partitions))
    if (longest or 0) <= limit:
        return SeriesLayout(spec)
    ensure_checkpoint_dir(spark)
    long = counts.where(F.col("_rows") > limit).checkpoint()
    key_bytes = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys), F.lit(32))
    n_bytes = long.agg(F.sum(key_bytes)).first()[0]

    # A series has a part in at most all tasks that its rows are sorted in.
    is_small = n_bytes + 64 * partitions <= MAX_BROADCAST_BYTES
    rows = _join(df, long.drop("_rows"), keys, "left_semi", is_small).withColumn(_TIE, F.rand(7))
    order = [*(F.col(k).asc_nulls_first() for k in keys), *spec.ascending()]
    rows = (
        rows.repartitionByRange(partitions, *order, F.col(_TIE))
        .sortWithinPartitions(*order)
        .drop(_TIE)
        .withColumn(_PLACE, F.monotonically_increasing_id())
        .checkpoint()
    )
    return SeriesLayout(spec, long, rows, limit, is_small)


def _join(left: DataFrame, right: DataFrame, on, how: str, is_small: bool) -> DataFrame:
    """Equi-join that also matches missing keys; sends ``right`` to all tasks if it is small."""
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in right.columns if c not in on]
    )
    if is_small:
        renamed = F.broadcast(renamed)
    matches = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    return left.join(renamed, matches, how).drop(*[f"_r_{c}" for c in on])
