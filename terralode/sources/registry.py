"""Which reader takes which extension; a reader gives one table or several."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from terralode.session import shared_dir
from terralode.sinks.tables import create_schema
from terralode.sources.archive import ZIPPED_DOCUMENTS, read_archives, save_members, stage_members, unpack
from terralode.sources.dbase import dbf_table, read_dbf
from terralode.sources.listing import literal_path
from terralode.sources.office import document_tables, open_parts, xml_parts
from terralode.sources.scripts import export_all_tables, run_sql_script
from terralode.sources.structured import read_geojson, read_json, read_kml, read_xml
from terralode.sources.tabular import read_csv, read_parquet, read_tsv, read_txt

Reader = Callable[[SparkSession, str], DataFrame]

# One file, one table, whatever compression Hadoop undoes on its own.
TABLE_READERS: dict[str, Reader] = {
    "csv": read_csv,
    "tsv": read_tsv,
    "txt": read_txt,
    "json": read_json,
    "jsonl": lambda spark, path: read_json(spark, path, lines=True),
    "xml": read_xml,
    "geojson": read_geojson,
    "kml": read_kml,
    "parquet": read_parquet,
    "pq": read_parquet,
    "dbf": read_dbf,
}
PARQUET_EXTENSIONS = ["parquet", "pq"]
TEXT_EXTENSIONS = [ext for ext in TABLE_READERS if ext not in (*PARQUET_EXTENSIONS, "dbf")]
# What can be read out of an archive.
MEMBER_EXTENSIONS = [*TABLE_READERS, *ZIPPED_DOCUMENTS]
ARCHIVES = ("zip", "tar", "tgz", "kmz", "xz", "gz", "bz2")
# Compressions Hadoop reads by itself when the inner file is text.
TRANSPARENT = ("gz", "bz2")


class NoReader(ValueError):
    """No reader takes the extension."""


def extension_of(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[-1].lower() if "." in name else ""


def stem_of(path: str) -> str:
    return re.sub(r"^(\.*[^.].*)\.[^.]*$", r"\1", path.rstrip("/").rsplit("/", 1)[-1])


def output_name(path: str) -> str:
    """Name of a file's table: the stem, less the inner suffix of a compressed text."""
    return stem_of(stem_of(path)) if extension_of(path) in TRANSPARENT and not must_unpack(path) else stem_of(path)


def read_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of a file by name. The path is one file's, taken as it is."""
    ext, place = extension_of(path), literal_path(path)
    if must_unpack(path):
        return read_archive_tables(spark, place)
    if ext in TRANSPARENT:
        inner = extension_of(stem_of(path)) or "txt"
        return {output_name(path): TABLE_READERS[inner](spark, place)}
    if ext == "sql":
        return read_script_tables(spark, place)
    if ext in ZIPPED_DOCUMENTS:
        tables = document_tables(open_parts(spark, place), ext)
        return {name or stem_of(path): df for (_, name), df in tables.items()}
    if ext not in TABLE_READERS:
        raise NoReader(f"no reader for .{ext}")
    return {stem_of(path): TABLE_READERS[ext](spark, place)}


def read_archive_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """A table per readable member, named by archive and member so that no two collide."""
    members = save_members(read_archives(spark, path), shared_dir(spark, "members"))
    staged = stage_members(members, TEXT_EXTENSIONS, PARQUET_EXTENSIONS)
    failed = members.filter(F.col("error").isNotNull()).select("member", "error").first()
    if failed:
        raise ValueError(f"{path}: {failed['member'] or 'archive'}: {failed['error']}")
    tables: dict[str, DataFrame] = {}
    for row in members.filter((F.col("part") == 0) & F.col("ext").isin(MEMBER_EXTENSIONS)).select("ext", "table").collect():
        tables |= read_member(spark, members, staged, row["ext"], row["table"])
    return tables


def read_member(spark: SparkSession, members: DataFrame, staged: str, ext: str, table: str) -> dict[str, DataFrame]:
    """The tables of one member: a staged file, or one still in the table of members."""
    if ext in TABLE_READERS and ext != "dbf":
        return {stem_of(table): TABLE_READERS[ext](spark, f"{staged}/ext={ext}/table={table}")}
    held = members.filter((F.col("ext") == ext) & (F.col("table") == table)).select(F.col("table").alias("path"), "content")
    if ext == "dbf":
        return {stem_of(table): dbf_table(held)}
    found = document_tables(xml_parts(unpack(held)), ext)
    return {"_".join(filter(None, (stem_of(table), name))): df for (_, name), df in found.items()}


def must_unpack(key: str) -> bool:
    """Whether a file is read by way of its members."""
    ext = extension_of(key)
    inner = extension_of(stem_of(key)) or "txt"
    return ext in ARCHIVES and not (ext in TRANSPARENT and inner in TEXT_EXTENSIONS)


def read_script_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables a SQL script makes, in a schema of its own under the shared folder."""
    script = spark.read.text(path, wholetext=True).first()["value"]
    location = shared_dir(spark, "script")
    schema = create_schema(spark, re.sub(r"\W", "_", location.rsplit("/", 1)[-1]), location)
    run_sql_script(spark, script, schema)
    return export_all_tables(spark, schema)

