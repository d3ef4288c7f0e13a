"""dBase tables: records cut out by their length, fields by their place with column expressions.

Records are of one length, so a file is read in ranges of whole records: its header, read
first, tells how many there are, and each task opens the file at its range.
"""

from __future__ import annotations

import struct
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terralode.operators.infer import type_columns
from terralode.operators.quality import assert_rows
from terralode.sources.archive import open_file
from terralode.sources.stores import require_file_system
from terralode.sources.listing import read_files

# Fixed values of the format: where the header keeps what, and how long a field's description is.
RECORDS_AT, HEADER_LENGTH_AT, RECORD_LENGTH_AT, FIELDS_AT, FIELD_LENGTH, MAX_HEADER = 4, 8, 10, 32, 32, 65535
END_OF_FIELDS, DELETED = 0x0D, 0x2A

BATCH_RECORDS = 10_000
# What a task reads of a file at most, rounded to whole records.
RANGE_BYTES = 64 * 1024 * 1024
MAX_TASKS = 100_000

# The function run in tasks travels with the job: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def byte_at(content: Column, offset: Column | int) -> Column:
    place = offset + 1 if isinstance(offset, Column) else F.lit(offset + 1)
    return F.conv(F.hex(F.substring(content, place, F.lit(1))), 16, 10).cast("int")


def little_endian(content: Column, offset: int, size: int) -> Column:
    """An unsigned number: int for two bytes, bigint for four."""
    kind = "int" if size <= 2 else "bigint"
    parts = [byte_at(content, offset + i).cast(kind) * F.lit(256**i).cast(kind) for i in range(size)]
    return sum(parts[1:], parts[0])


def layout_of(content: Column) -> Column:
    """A digest of what the header says of records and fields; empty where there is no header."""
    head = F.substring(content, 1, MAX_HEADER)
    described = F.substring(head, F.lit(FIELDS_AT + 1), little_endian(head, HEADER_LENGTH_AT, 2) - FIELDS_AT)
    return F.coalesce(F.sha2(F.concat(F.substring(head, RECORD_LENGTH_AT + 1, 2), described), 256), F.lit(""))


def dbf_fields(files: DataFrame) -> DataFrame:
    """One row per layout and field: the layout, the field's place in the record, name, type and length."""
    # The header is cut off first: every look at a value copies it.
    files = files.select(layout_of(F.col("content")).alias("layout"), F.substring("content", 1, MAX_HEADER).alias("content"))
    files = files.groupBy("layout").agg(F.min("content").alias("content"))
    content = F.col("content")
    start = lambda i: i * FIELD_LENGTH + FIELDS_AT
    count = ((little_endian(content, HEADER_LENGTH_AT, 2) - FIELDS_AT) / FIELD_LENGTH).cast("int")
    described = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.struct(
            i.alias("i"),
            byte_at(content, start(i)).alias("first"),
            F.substring(content, start(i) + 1, F.lit(11)).alias("name"),
            F.substring(content, start(i) + 12, F.lit(1)).cast("string").alias("kind"),
            byte_at(content, start(i) + 16).alias("length"),
        ),
    )
    # The list of fields ends early where a description would start with the end mark.
    end = F.array_min(F.transform(F.filter(described, lambda f: f["first"] == END_OF_FIELDS), lambda f: f["i"]))
    kept = F.filter(described, lambda f: end.isNull() | (f["i"] < end))
    name = F.regexp_replace(F.col("f.name").cast("string"), "\\x00.*$", "")
    return files.select("layout", F.explode_outer(kept).alias("f")).select("layout", "f.i", name.alias("name"), "f.kind", "f.length").orderBy("layout", "i")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of fixed length, those marked deleted left out, some thousand at a time."""
    for batch in batches:
        for path, layout, content in zip(batch["path"], batch["layout"], batch["content"]):
            data = content.as_buffer().to_pybytes()
            count, header, size = struct.unpack_from("<IHH", data, RECORDS_AT)
            if len(data) < header + count * size:
                raise ValueError(f"{path.as_py()}: {len(data)} bytes, where its header tells of {count} records of {size} after {header}")
            for first in range(0, count, BATCH_RECORDS):
                places = range(header + first * size, header + min(first + BATCH_RECORDS, count) * size, size)
                records = [data[p : p + size] for p in places if data[p] != DELETED]
                yield pa.RecordBatch.from_arrays([pa.array([layout.as_py()] * len(records), type=pa.string()), pa.array(records, type=pa.binary())], names=["layout", "record"])


def dbf_records(files: DataFrame) -> DataFrame:
    """One row per record that is not marked deleted, as bytes, with its file's layout. A file shorter than its header says fails."""
    return files.select("path", layout_of(F.col("content")).alias("layout"), "content").mapInArrow(_cut, "layout string, record binary")


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first bytes of each file, opened where it lies."""
    for batch in batches:
        heads = []
        for path in batch["path"].to_pylist():
            with open_file(path) as file:
                heads.append(file.read(MAX_HEADER))
        yield pa.RecordBatch.from_arrays([batch["path"], batch["length"], pa.array(heads, pa.binary())], names=["path", "length", "content"])


def file_heads(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path, length, content`` of every file, the content being its header and at most 64 KB."""
    for one in [path] if isinstance(path, str) else path:
        require_file_system(one)
    return read_files(spark, path).select("path", "length").mapInArrow(_heads, "path string, length bigint, content binary")


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of ranges of files, those marked deleted left out, some thousand at a time."""
    for batch in batches:
        for row in batch.to_pylist():
            with open_file(row["path"]) as file:
                file.seek(row["offset"])
                left, size = row["records"], row["size"]
                while left:
                    n = min(left, BATCH_RECORDS)
                    data = file.read(n * size)
                    if len(data) < n * size:
                        raise ValueError(f"{row['path']}: ends before its last record")
                    records = [data[p : p + size] for p in range(0, len(data), size) if data[p] != DELETED]
                    yield pa.RecordBatch.from_arrays([pa.array([row["layout"]] * len(records), pa.string()), pa.array(records, pa.binary())], names=["layout", "record"])
                    left -= n


def range_records(heads: DataFrame) -> DataFrame:
    """As ``dbf_records``, of files given by ``file_heads``: read in ranges, a task for each.

    A file shorter than its header says fails before any record is read.
    """
    content = F.col("content")
    told = heads.select(
        "path",
        "length",
        layout_of(content).alias("layout"),
        little_endian(content, RECORDS_AT, 4).alias("count"),
        little_endian(content, HEADER_LENGTH_AT, 2).alias("start"),
        little_endian(content, RECORD_LENGTH_AT, 2).alias("size"),
    )
    short = F.col("size").isNull() | (F.col("length") < F.col("start") + F.col("count") * F.col("size"))
    says = F.concat_ws("", "path", F.lit(": "), "length", F.lit(" bytes, where its header tells of "), "count", F.lit(" records"))
    told = assert_rows(told, ~short, says).where("count > 0 and size > 0")
    step = F.greatest(F.lit(1), F.floor(F.lit(RANGE_BYTES) / F.col("size")))
    tasks = told.agg(F.sum(F.ceil(F.col("count") / step))).first()[0] or 1
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("count") - 1, step)).alias("first")
    ranges = told.select("path", "layout", "start", "size", "count", step.alias("step"), first).select(
        "path",
        "layout",
        (F.col("start") + F.col("first") * F.col("size")).alias("offset"),
        F.least("step", F.col("count") - F.col("first")).alias("records"),
        "size",
    )
    # A number given keeps them apart: ranges are small rows, which would be merged into few tasks.
    return ranges.repartition(min(int(tasks), MAX_TASKS)).mapInArrow(_ranges, "layout string, record binary")


def field_text(kind: str, start: int, length: int, encoding: str) -> Column:
    """Text of one field of a record; null when it holds nothing."""
    raw = F.substring("record", start, length)
    if kind == "I":
        bits = little_endian(raw, 0, 4)
        return F.when(bits >= 2**31, bits - 2**32).otherwise(bits).cast("string")
    text = F.regexp_replace(F.decode(raw, encoding), "[ \\x00]+$", "")
    if kind in ("N", "F"):
        return F.nullif(F.regexp_replace(F.trim(text), "^[*]+$", ""), F.lit(""))
    if kind == "D":
        return F.date_format(F.try_to_timestamp(F.nullif(F.trim(text), F.lit("")), F.lit("yyyyMMdd")), "yyyy-MM-dd")
    if kind == "L":
        return F.when(text.isin("T", "t", "Y", "y"), "True").when(text.isin("F", "f", "N", "n"), "False")
    return text


def dbf_table(files: DataFrame, encoding: str = "UTF-8") -> DataFrame:
    """The table of dBase files, given as ``(path, content)``, each read by its own layout."""
    return fields_table(dbf_fields(files), dbf_records(files), encoding)


def fields_table(described: DataFrame, records: DataFrame, encoding: str = "UTF-8") -> DataFrame:
    """The fields of records by the descriptions of their layouts.

    Columns are those of all layouts by name, null where a file has no such field; one that
    is text in some layout is text. Names that differ only in case are one column.
    """
    layouts: dict[str, list] = {}
    for field in described.collect():
        layouts.setdefault(field["layout"], []).append(field)
    if any(field["name"] is None for fields in layouts.values() for field in fields):
        raise ValueError("a dBase file without fields")
    texts: dict[str, list[tuple[str, Column]]] = {}
    names: dict[str, str] = {}
    kinds: dict[str, set[str]] = {}
    for layout, fields in layouts.items():
        start = 2
        for field in fields:
            key = field["name"].lower()
            names.setdefault(key, field["name"])
            kinds.setdefault(key, set()).add(field["kind"])
            texts.setdefault(key, []).append((layout, field_text(field["kind"], start, field["length"], encoding)))
            start += field["length"]
    columns = []
    for key, own in texts.items():
        text = own[0][1] if len(layouts) == 1 else F.coalesce(*[F.when(F.col("layout") == layout, found) for layout, found in own])
        columns.append(text.alias(names[key]))
    typed = [names[key] for key, own in kinds.items() if own <= {"N", "F", "I", "L"}]
    return type_columns(records.select(columns), [], typed)


def read_dbf(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    heads = file_heads(spark, path)
    return fields_table(dbf_fields(heads), range_records(heads), encoding)


