"""One commit for all tables that a run writes.

Two tables cannot be written at once. A batch therefore counts as stored only when the log says so:
its rows are written table by table, marked with the batch id, and one small file in the log makes
them all visible together. Readers ask for the rows of committed batches (`BatchLog.visible`); what
a failed run has left is never among them.

Tables that are partitioned by batch take a repeated attempt in place of the failed one. A database
cannot; there an unfinished batch id is refused, and a new one makes the old rows invisible for good.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks.outputs import save
from tidemark.sources.jdbc import JdbcTable

_SCHEMA = "BatchId string, State string, Outputs map<string, bigint>, LoggedAt timestamp"
_BEGUN, _DONE = "begun", "done"


@dataclass(frozen=True)
class BatchLog:
    """A folder with a small parquet file per entry, on any storage that the session can reach."""

    spark: SparkSession
    path: str

    def entries(self) -> DataFrame:
        """All entries; none where the folder is not there yet."""
        try:
            return self.spark.read.schema(_SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _SCHEMA)

    def batches(self) -> DataFrame:
        """One row per committed batch: BatchId, and the rows written by output."""
        done = self.entries().where(F.col("State") == _DONE)
        return done.groupBy("BatchId").agg(F.min_by("Outputs", "LoggedAt").alias("Outputs"))

    def outputs(self, batch_id: str) -> dict[str, int] | None:
        """The rows written by output, or None for a batch that is not committed."""
        row = self.batches().where(F.col("BatchId") == batch_id).first()
        return None if row is None else dict(row["Outputs"])

    def visible(self, df: DataFrame) -> DataFrame:
        """The rows of committed batches. The list of batches is small; Spark sends it to all tasks
        while it is and skips the partitions of other batches."""
        return df.join(self.batches().select("BatchId"), "BatchId", "left_semi").select(df.columns)

    def is_begun(self, batch_id: str) -> bool:
        return not self.entries().where(F.col("BatchId") == batch_id).isEmpty()

    def _write(self, batch_id: str, state: str, outputs: Mapping[str, int]) -> None:
        entry = self.spark.range(1).select(
            F.lit(batch_id).alias("BatchId"),
            F.lit(state).alias("State"),
            F.create_map(*[F.lit(x) for pair in outputs.items() for x in pair]).cast("map<string, bigint>").alias("Outputs"),
            F.current_timestamp().alias("LoggedAt"),
        )
        entry.coalesce(1).write.mode("append").parquet(self.path)

    def store(self, batch_id: str, outputs: Mapping[str, tuple[DataFrame, JdbcTable | str]]) -> dict[str, int]:
        """Write every (frame, target) and commit them together; the rows written by output.

        All rows must carry the batch id in their column BatchId. A batch that is committed is not
        written again. A path or a catalog table is written by partitions of BatchId, so a repeated
        attempt replaces what the one before has left.
        """
        known = self.outputs(batch_id)
        if known is not None:
            return known
        if any(isinstance(target, JdbcTable) for _, target in outputs.values()) and self.is_begun(batch_id):
            raise ValueError(f"batch {batch_id} was begun and not finished; a database needs a new batch id")
        self._write(batch_id, _BEGUN, {})
        written = {}
        for name, (df, target) in outputs.items():
            if isinstance(target, JdbcTable):
                written[name] = save(df, target)
            else:
                written[name] = save(df, target, "overwrite", partition_by=("BatchId",), replace="partitions")
        self._write(batch_id, _DONE, written)
        return written
