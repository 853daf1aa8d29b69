"""A session with the settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def spark_session(
    app_name: str = "tidemark",
    master: str | None = None,
    packages: str | None = None,
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Create or get a session in UTC with adaptive execution.

    ``packages`` names the Maven coordinates of a JDBC driver. Leave
    ``shuffle_partitions`` unset to keep the cluster's own setting.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Checkpoint files go when the frames they belong to are gone.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Windows cost far more per byte than scans do: use the cores there are before
        # merging small shuffle partitions.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
    )
    if master:
        builder = builder.master(master)
    if packages:
        builder = builder.config("spark.jars.packages", packages)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in (settings or {}).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark
