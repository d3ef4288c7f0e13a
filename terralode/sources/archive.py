"""Archives: one row per member file."""

from __future__ import annotations

import bz2
import gzip
import io
import lzma
import sys
import tarfile
import zipfile
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from terralode.functions.names import basename, file_extension
from terralode.session import shared_dir
from terralode.sources.listing import read_files
from terralode.sources.stores import file_store, require_file_system

# The functions run in tasks travel with the job: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEMBER_SCHEMA = "archive string, member string, part int, size bigint, content binary, error string"
ARROW_SCHEMA = pa.schema(
    [
        ("archive", pa.string()),
        ("member", pa.string()),
        ("part", pa.int32()),
        ("size", pa.int64()),
        ("content", pa.binary()),
        ("error", pa.string()),
    ]
)
# Members are handed back once they come to this many bytes or rows: a task holds them, their batch and its copy on the way out.
BATCH_BYTES = 4 * 1024 * 1024
BATCH_ROWS = 4096
# A longer text member comes in parts of about this size, each ending with a line.
PART_BYTES = 64 * 1024 * 1024
# Members that only make sense whole, and where a value of the binary type ends.
WHOLE_EXTENSIONS = ("parquet", "pq", "dbf", "xlsx", "ods", "docx", "odt")
MAX_VALUE_BYTES = 2**31 - 1024

# Archive kinds by extension, and what one compressed file is read with.
CONTAINERS = ("zip", "kmz", "tar", "tgz")
# Files that are zips of XML parts; inside another archive they stay one member.
ZIPPED_DOCUMENTS = ("xlsx", "ods", "docx", "odt")
CODECS = {"gz": gzip.open, "bz2": bz2.open, "xz": lzma.open}
ARCHIVE_EXTENSIONS = CONTAINERS + tuple(CODECS)

# Last bytes of every Parquet file.
PARQUET_MAGIC = "PAR1"


def _extension(name: str) -> str:
    last = name.rsplit("/", 1)[-1]
    return last.rsplit(".", 1)[-1].lower() if "." in last else ""


def _contents(name: str, source: BinaryIO) -> Iterator[tuple[str, Callable[[], BinaryIO]]]:
    """Names of the files in an archive, each with a way to open it."""
    kind = _extension(name)
    if kind in CODECS:
        inner = name[: -len(kind) - 1].rsplit("/", 1)[-1]
        yield inner if "." in inner else inner + ".txt", lambda: CODECS[kind](source)
    elif kind in ("zip", "kmz", *ZIPPED_DOCUMENTS):
        archive = zipfile.ZipFile(source)
        for info in archive.infolist():
            if not info.is_dir():
                yield info.filename, lambda info=info: archive.open(info)
    else:
        archive = tarfile.open(fileobj=source, mode="r:*")
        for info in archive:
            if info.isfile():
                yield info.name, lambda info=info: archive.extractfile(info)


def _parts(member: str, stream: BinaryIO, whole: bool) -> Iterator[tuple[bytes | None, str | None]]:
    """Contents of a member: one value, or for a long text several that end with a line."""
    if whole or _extension(member) in WHOLE_EXTENSIONS:
        data = stream.read(MAX_VALUE_BYTES + 1)
        yield (data, None) if len(data) <= MAX_VALUE_BYTES else (None, "too large for one value")
        return
    # Bytes are gathered until a line ends; the rest opens the next part.
    held = stream.read(PART_BYTES)
    while more := stream.read(PART_BYTES):
        end = held.rfind(b"\n") + 1
        if end:
            yield held[:end], None
        held = held[end:] + more
        if len(held) > MAX_VALUE_BYTES:
            yield None, "a line too large for one value"
            return
    yield held, None


def _members(name: str, source: BinaryIO) -> Iterator[tuple[str, int, bytes | None, str | None]]:
    """Files of an archive, archives inside it opened in turn; member paths are kept.

    The parts of a workbook or document are XML, which only parses whole: they are never cut.
    """
    whole = _extension(name) in ZIPPED_DOCUMENTS
    for member, opened in _contents(name, source):
        with opened() as stream:
            if _extension(member) in ARCHIVE_EXTENSIONS:
                # A decompressed stream is read through as it comes, a member is held.
                inner = stream if _extension(name) in CODECS else io.BytesIO(stream.read())
                for deeper, part, data, problem in _members(member, inner):
                    yield f"{member}/{deeper}", part, data, problem
            else:
                for part, (data, problem) in enumerate(_parts(member, stream, whole)):
                    yield member, part, data, problem


def open_file(path: str) -> BinaryIO:
    """A file of any file system in the list, read where it lies, whatever its size and name."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return open("/" + (rest or path).lstrip("/"), "rb")
    filesystem, key = file_store(path)
    return filesystem.open_input_file(key)


def _rows(path: str, content: bytes | None) -> Iterator[tuple]:
    try:
        source = open_file(path) if content is None else io.BytesIO(content)
        for member, part, data, problem in _members(path, source):
            yield path, member, part, None if data is None else len(data), data, problem
    except Exception as problem:  # a broken archive is reported, not fatal
        yield path, None, None, None, None, repr(problem)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members in batches of bounded size, so a task holds one archive and a few members."""
    held, held_bytes = [], 0
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            for row in _rows(path.as_py(), content.as_py()):
                size = row[3] or 0
                if held and held_bytes + size > BATCH_BYTES or len(held) >= BATCH_ROWS:
                    yield _batch(held)
                    held, held_bytes = [], 0
                held.append(row)
                held_bytes += size
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(column), type=field.type) for column, field in zip(zip(*rows), ARROW_SCHEMA)], schema=ARROW_SCHEMA
    )


def unpack(archives: DataFrame) -> DataFrame:
    """Members of archives given as ``(path, content)`` rows.

    A null content has the task open the path itself. A long text member gives
    several rows, numbered by ``part``. A broken archive gives an error row.
    """
    members = archives.select("path", "content").mapInArrow(_unpack, MEMBER_SCHEMA)
    return members.withColumn("ext", file_extension(basename(F.col("member"))))


def unpack_files(files: DataFrame) -> DataFrame:
    """Members of listed archive files. The task opens each and reads it in place, whatever its size."""
    return unpack(files.select("path", F.lit(None).cast("binary").alias("content")))


def read_archives(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Members of every archive below a path."""
    for one in [path] if isinstance(path, str) else path:
        require_file_system(one)
    return unpack_files(read_files(spark, path, glob))


def save_members(members: DataFrame, path: str) -> DataFrame:
    """Members as a table by extension, so that archives are opened once however often it is read.

    ``table`` names what a member becomes: archive and member, so that no two collide.
    """
    table = F.regexp_replace(F.concat_ws("/", basename(F.col("archive")), "member"), r"[^\w.\-]+", "_")
    named = members.withColumn("table", table)
    named.write.mode("overwrite").partitionBy("ext").parquet(path)
    # The given schema keeps an extension such as 001 a text.
    return members.sparkSession.read.schema(named.schema).parquet(path)


def stage_members(members: DataFrame, texts: list[str], parquets: list[str] = ()) -> str:
    """Write saved members out as files of their own, so the ordinary readers can take them.

    Files go to ``ext=<ext>/table=<name>`` under a fresh shared folder. The text
    sink writes the bytes as they are and ends each row with its line separator: a
    part of a text ends with a line anyway, and a Parquet file gets its own last
    four bytes back that way.
    """
    staged = shared_dir(members.sparkSession, "staged")
    good = members.filter(F.col("error").isNull())
    # Cut as bytes: the text may be in any encoding.
    content, size = F.col("content"), F.length("content")
    line_end = F.substring(content, size, F.lit(1)) == F.lit(bytearray(b"\n"))
    line_by_line = F.when(line_end, F.substring(content, F.lit(1), size - 1)).otherwise(content).cast("string")
    text = good.filter(F.col("ext").isin(list(texts))).select(line_by_line.alias("value"), "ext", "table", "part")
    # Only a member of several parts must come together in one task, in order.
    long = [r["table"] for r in text.filter("part > 0").select("table").distinct().collect()]
    ordered = text.filter(F.col("table").isin(long)).repartition("ext", "table").sortWithinPartitions("ext", "table", "part")
    for frame in (text.filter(~F.col("table").isin(long)), ordered) if long else (text,):
        frame.drop("part").write.mode("append").partitionBy("ext", "table").text(staged)
    if parquets:
        body = F.expr(f"cast(substring(content, 1, length(content) - {len(PARQUET_MAGIC)}) as string)")
        binary = good.filter(F.col("ext").isin(list(parquets))).select(body.alias("value"), "ext", "table")
        binary.write.mode("append").option("lineSep", PARQUET_MAGIC).partitionBy("ext", "table").text(staged)
    return staged
