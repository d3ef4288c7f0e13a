"""Every object below a path, listed by tasks, whatever its name and size."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from terralode.session import local_rows, shared_dir
from terralode.sources.stores import file_store, require_file_system

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ENTRY_SCHEMA = "key string, is_folder boolean, size_bytes bigint, last_modified timestamp"
ARROW_SCHEMA = pa.schema(
    [("key", pa.string()), ("is_folder", pa.bool_()), ("size_bytes", pa.int64()), ("last_modified", pa.timestamp("us", "UTC"))]
)
BATCH_ROWS = 10_000
# Folders one task lists.
TASK_FOLDERS = 32
# What Hadoop and Spark leave beside the files they write.
MARKERS = re.compile(r"_SUCCESS|_temporary|_spark_metadata|\.spark-staging-.*|\..*\.crc")


def entries_of(root: str, folder: str) -> Iterator[tuple]:
    """What stands in one folder, by key below the root."""
    store, top = file_store(root)
    top = top.rstrip("/")
    for entry in store.get_file_info(fs.FileSelector(f"{top}/{folder}".rstrip("/"), recursive=False)):
        if not MARKERS.fullmatch(entry.base_name):
            is_folder = entry.type == fs.FileType.Directory
            yield f"{folder}/{entry.base_name}".lstrip("/"), is_folder, None if is_folder else entry.size, entry.mtime


def list_folders(folders: DataFrame, root: str) -> DataFrame:
    """What stands in each folder of a ``folder`` column; a folder that cannot be listed fails."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for folder in batch["folder"].to_pylist():
                for entry in entries_of(root, folder):
                    held.append(entry)
                    if len(held) == BATCH_ROWS:
                        yield entry_batch(held)
                        held = []
        if held:
            yield entry_batch(held)

    return folders.mapInArrow(listed, ENTRY_SCHEMA)


def entry_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), ARROW_SCHEMA)], schema=ARROW_SCHEMA)


def list_every_object(spark: SparkSession, path: str) -> DataFrame:
    """Key, size and time of change of every object below a folder.

    Hidden names, names with signs of a pattern and empty files are listed too; only the
    markers of Hadoop and Spark are left out. Each job lists the folders that the one before
    it found and keeps what it finds as a table, so the driver holds no name.
    """
    require_file_system(path)
    found = shared_dir(spark, "listing")
    level, depth, folders = local_rows(spark, [("",)], "folder string"), 0, 1
    while folders:
        tasks = -(-folders // TASK_FOLDERS)
        list_folders(level.repartition(tasks) if tasks > 1 else level, path).write.parquet(f"{found}/level={depth}")
        inner = spark.read.schema(ENTRY_SCHEMA).parquet(f"{found}/level={depth}").where("is_folder")
        level, folders, depth = inner.select(F.col("key").alias("folder")), inner.count(), depth + 1
    return spark.read.schema(ENTRY_SCHEMA).parquet(found).where("not is_folder").select("key", "size_bytes", "last_modified")
