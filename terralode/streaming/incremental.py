"""Files taken in once each, the checkpoint standing in for the ledger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def incremental_ingest(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: str | T.StructType,
    file_format: str = "parquet",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    max_files: int | None = None,
    **options: str,
) -> str:
    """Take in the files that came since the last run, then stop.

    The checkpoint and the sink's own log make each file count once, also when a
    run breaks off and is started again. ``max_files`` bounds a micro-batch.
    """
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.load(source)
    if transform is not None:
        stream = transform(stream)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
    return target


def on_new_files(
    spark: SparkSession,
    source: str,
    checkpoint: str,
    handle: Callable[[DataFrame], None],
    glob: str | None = None,
) -> None:
    """Call ``handle`` with the listing of files that came since the last run; no file is opened."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    listing = reader.load(source).select("path", "length", "modificationTime")
    query = (
        listing.writeStream.foreachBatch(lambda batch, _: handle(batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
