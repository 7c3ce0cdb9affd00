"""Session settings the library relies on, and a local session for tests and benchmarks."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Read by Catalyst at plan time; safe to set on any session, local or cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
}


# Aim for shuffle partitions of this size: they sort in memory and keep the task count moderate.
_PARTITION_BYTES = 256 << 20


def cluster_settings(input_bytes: int) -> dict[str, str]:
    """Settings for a job that shuffles about ``input_bytes``: 100 TB give some 400,000 partitions.

    AQE merges partitions that turn out small, so the number may be generous; it cannot split a
    partition of a range sort, so it must not be too low.
    """
    partitions = max(200, -(-input_bytes // _PARTITION_BYTES))
    return SETTINGS | {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(_PARTITION_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_PARTITION_BYTES),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def local_session(
    cores: str = "8", shuffle_partitions: int = 8, app: str = "saleshouse", broadcast_limit: str = "10m"
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.sql.autoBroadcastJoinThreshold", broadcast_limit)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
