"""Where Python workers find this package."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

import tidemark


def workers_find_package(spark: SparkSession) -> None:
    """Put the folder of the package on the workers' path.

    This serves sessions whose workers see the same installation, but were started elsewhere;
    where executors have no copy, submit the package with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(tidemark.__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [paths, root]))
