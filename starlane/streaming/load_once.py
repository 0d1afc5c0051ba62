"""Bulk load that takes each file once."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILES_PER_TRIGGER = 10_000


def load_once(
    spark: SparkSession,
    files: str,
    target: str,
    checkpoint: str,
    schema: T.StructType,
    multi_line: bool = False,
    partition_by: str | None = None,
) -> None:
    """Append the JSON files under ``files`` not loaded before to the Parquet table ``target``.

    A file stream that stops when it has caught up: the checkpoint remembers
    the files, and the target's own log leaves out a half-written batch. Taking the
    latest files first is what lifts the stream's age limit, so a file that arrives
    with an old time stamp is loaded like any other. ``source_file`` is the whole path.
    """
    rows = (
        spark.readStream.schema(schema)
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", partition_by is None)
        .option("latestFirst", True)
        .option("maxFilesPerTrigger", FILES_PER_TRIGGER)
        .json(files)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )
    writer = (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", target)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.start().awaitTermination()
