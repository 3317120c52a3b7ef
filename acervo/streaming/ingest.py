"""Load the files of a folder that were not loaded yet."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T


def load_new_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    files_per_batch: int = 10_000,
) -> None:
    """Append the JSON files that arrived since the last call to the Parquet table at ``target``.

    The checkpoint remembers the files and the sink commits each batch once, so running again,
    also after a failure, loads no row twice. ``checkpoint`` and ``target`` must be shared folders.
    """
    arrivals = (
        spark.readStream.schema(schema)
        .option("multiLine", False)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(folder)
    )
    query = (
        arrivals.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
