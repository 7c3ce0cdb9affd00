"""Load files that arrived since the last run, each exactly once.

The stream's checkpoint remembers which files were read. Each micro-batch writes a folder named by
its batch id, so a batch that is repeated after a failure replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import files


def ingest_available(
    spark: SparkSession, source: str, target: str, checkpoint: str, on_error: str = "CONTINUE",
    glob: str = "*.csv", files_per_batch: int | None = None,
) -> DataFrame:
    """Read every new CSV file below ``source`` into ``target``, then stop. Returns all rows loaded so far."""
    stream = files.csv_reader(spark.readStream).option("pathGlobFilter", glob)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)

    def store(batch: DataFrame, batch_id: int) -> None:
        kept, _ = files.apply_error_policy(files.number_rows(batch), on_error)
        files.as_raw(kept).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    query = (
        files.with_origin(stream.csv(source))
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return loaded(spark, target)


def loaded(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).drop("batch")
