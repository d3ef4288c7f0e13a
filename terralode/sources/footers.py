"""Sizes and row counts of tables out of their files' listings and Parquet footers, by tasks."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from terralode.sources.stores import FILE_SYSTEMS, file_store

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILE_SCHEMA = "table_name string, place string, name string, bytes bigint, changed timestamp"
ARROW_FILES = pa.schema(
    [("table_name", pa.string()), ("place", pa.string()), ("name", pa.string()), ("bytes", pa.int64()), ("changed", pa.timestamp("us", "UTC"))]
)
BATCH_ROWS = 10_000


def is_data(path: str, top: str) -> bool:
    """Whether Spark reads a file of a table's folder: no part of its path below the folder is hidden."""
    parts = path[len(top) :].strip("/").split("/")
    return not any(part.startswith(".") or part.startswith("_") and "=" not in part for part in parts)


def table_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files below the ``place`` of each table, or the one it is."""
    for batch in batches:
        for table, place in zip(batch["table_name"].to_pylist(), batch["place"].to_pylist()):
            store, top = file_store(place)
            (own,) = store.get_file_info([top])
            is_folder = own.type != fs.FileType.File
            entries = store.get_file_info(fs.FileSelector(top, recursive=True, allow_not_found=True)) if is_folder else [own]
            rows = [(table, place, e.path, e.size, e.mtime) for e in entries if e.type == fs.FileType.File and is_data(e.path, top)]
            for at in range(0, len(rows), BATCH_ROWS):
                columns = zip(*rows[at : at + BATCH_ROWS])
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, ARROW_FILES)], schema=ARROW_FILES)


def with_row_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of rows each file's footer gives; nothing else of the file is read."""
    for batch in batches:
        counts = []
        for place, name in zip(batch["place"].to_pylist(), batch["name"].to_pylist()):
            with file_store(place)[0].open_input_file(name) as file:
                counts.append(pq.read_metadata(file).num_rows)
        yield batch.append_column("rows", pa.array(counts, type=pa.int64()))


def is_readable(provider: Column, place: Column) -> Column:
    """Whether a table is of Parquet files that tasks can open."""
    scheme = F.regexp_extract(place, "^([^:/]+):", 1)
    return (F.lower(provider) == "parquet") & (place != "") & scheme.isin("", *FILE_SYSTEMS)


def footer_statistics(tables: DataFrame) -> DataFrame:
    """``table_name, row_count, bytes, created, last_altered`` of Parquet tables given by ``table_name`` and ``place``.

    Two jobs whatever the number of tables: one lists their files, one reads the footers, the
    files dealt over all tasks. A table without files has no rows, and no size or age.
    """
    named = tables.select("table_name", "place")
    # By number, so that listings of few bytes are not put together into one task.
    tasks = tables.sparkSession.sparkContext.defaultParallelism
    files = named.repartition(tasks, "table_name").mapInArrow(table_files, FILE_SCHEMA).repartition(tasks, "name")
    counted = files.mapInArrow(with_row_counts, FILE_SCHEMA + ", rows bigint")
    by_table = counted.groupBy("table_name").agg(
        F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.min("changed").alias("created"), F.max("changed").alias("last_altered")
    )
    found = named.select("table_name").join(by_table, "table_name", "left")
    return found.select("table_name", F.coalesce("rows", F.lit(0)).alias("row_count"), "bytes", "created", "last_altered")
