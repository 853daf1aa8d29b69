"""The shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure ``DataFrame.checkpoint()`` has a folder that all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where all
    tasks run in the driver, falls back to a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tidemark-")
    context.setCheckpointDir(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system its path names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` computed once and written to the shared folder, for several readers of some columns each.

    Unlike a persisted frame it survives lost executors and takes no executor memory. The files
    are removed at the end.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/staged-{uuid4()}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(spark, path)
