"""Where intermediate tables live, and how they are written.

Everything is written below the folder named by ``spark.checkpoint.dir``, which every
executor can reach, so a lost executor never takes an intermediate result with it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_KEY = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
CODEC = "zstd"  # of the tables written here: about two thirds of the bytes of the session's default


def work_dir(spark: SparkSession) -> str:
    """Shared folder of this application, without a trailing slash."""
    root = spark.conf.get(_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_KEY} to a folder every executor can reach")
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/work"
    return f"{root.rstrip('/')}/saleshouse/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """For a write whose table is what is read from here on: the shuffle files of its making go as it ends, not when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: cuts lineage and fixes the rows for every later use."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with shuffles_go(spark):
        df.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def fixed_now(spark: SparkSession) -> Column:
    """This moment as a literal: every later read of a plan that holds it gives the same time."""
    now = spark.sql("SELECT CAST(CAST(current_timestamp() AS timestamp_ntz) AS string)").first()[0]
    return F.lit(now).cast("timestamp_ntz")


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _filesystem(spark, path)
    return fs.exists(target)


def make_folder(spark: SparkSession, path: str) -> None:
    """An empty folder, where there is none yet."""
    fs, target = _filesystem(spark, path)
    fs.mkdirs(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _filesystem(spark, path)
    fs.delete(target, True)


def drop_work_tables(spark: SparkSession) -> None:
    """Delete every intermediate table of this application. Call when no result is still in use."""
    delete(spark, work_dir(spark))


# --- versioned tables: plain Parquet has no MERGE, and a path must not be overwritten while read


def finished(spark: SparkSession, base: str, names: str) -> list[str]:
    """Names of the folders below ``base`` that a write has ended in."""
    fs, pattern = _filesystem(spark, f"{base}/{names}/_SUCCESS")
    return sorted(found.getPath().getParent().getName() for found in fs.globStatus(pattern) or [])


def _versions(spark: SparkSession, base: str) -> list[int]:
    return sorted(int(name.split("=")[1]) for name in finished(spark, base, "version=*"))


def publish(df: DataFrame, base: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as the next version of ``base``. Readers of the old version are not disturbed.

    The newest folder with a ``_SUCCESS`` marker is the current version, so a job that dies half
    way leaves the old version current.
    """
    spark = df.sparkSession
    versions = _versions(spark, base)
    number = versions[-1] + 1 if versions else 1
    path = f"{base}/version={number}"
    with shuffles_go(spark):
        df.write.mode("overwrite").option("compression", CODEC).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def current(spark: SparkSession, base: str) -> DataFrame:
    versions = _versions(spark, base)
    if not versions:
        raise FileNotFoundError(f"no finished version below {base}")
    return spark.read.parquet(f"{base}/version={versions[-1]}")
