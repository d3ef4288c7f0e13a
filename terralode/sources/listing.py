"""Listings of files, models, tables, and the tail of a log."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terralode.functions.names import basename, is_folder_key
from terralode.session import local_rows
from terralode.sources.footers import footer_statistics, is_readable


def read_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """The files below a path. Only the columns used are read, so a listing opens no file."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def literal_path(path: str) -> str:
    """A path whose name is taken as it is, whatever signs of a pattern it holds."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def relative_key(root: str, path: Column) -> Column:
    """Key of a listed file: its path below the root listed."""
    return F.substring_index(path, root.rstrip("/").split(":", 1)[-1].lstrip("/") + "/", -1)


def source_path() -> Column:
    """Path of the file a row was read from, its escapes undone."""
    return F.url_decode(F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B")))


def list_objects(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Key, size and time of change of every object, folder markers left out."""
    return (
        read_files(spark, path, glob)
        .select(
            relative_key(path, F.col("path")).alias("key"),
            F.col("length").alias("size_bytes"),
            F.col("modificationTime").alias("last_modified"),
        )
        .filter(~is_folder_key(F.col("key")))
    )


def list_keys(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    return list_objects(spark, path, glob).select("key")


def list_models(spark: SparkSession, path: str, glob: str = "*.sql") -> DataFrame:
    """Model files by name, newest first."""
    return (
        read_files(spark, path, glob)
        .select(basename(F.col("path")).alias("file"), F.col("modificationTime").alias("mtime"))
        .orderBy(F.col("mtime").desc(), "file")
    )


def if_exists(load: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``load`` reads, or nothing when there is no such path."""
    try:
        return load()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def tail_lines(spark: SparkSession, path: str, n: int = 200) -> DataFrame:
    """The last ``n`` lines of a log, in order; one marker row when there is none.

    The log is a file or a folder of parts that follow one another by name. A line's
    place is its part, the offset of its split and its number inside it, so a long
    log is read in parallel and each task keeps ``n`` lines at most.
    """
    text = if_exists(lambda: spark.read.text(path))
    if text is None:
        missing = [(path, 0, 0, f"[missing] {path}")]
        return local_rows(spark, missing, "part string, block bigint, nth bigint, line string")
    lines = text.select(
        F.col("_metadata.file_path").alias("part"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"),
        F.col("value").alias("line"),
    )
    last = lines.orderBy(F.col("part").desc(), F.col("block").desc(), F.col("nth").desc()).limit(n)
    return last.orderBy("part", "block", "nth")


def probe_session(spark: SparkSession) -> DataFrame:
    """Whether the engine answers: its version, the catalog in use, and a word."""
    return spark.sql("SELECT version() AS version, current_catalog() AS catalog, 'ok' AS status")


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    """Tables of a schema, as the catalog lists them."""
    return spark.sql(f"SHOW TABLES IN `{schema}`").filter(~F.col("isTemporary")).select("tableName")


def described_tables(spark: SparkSession, schema: str) -> DataFrame:
    """``table_name``, ``provider`` and ``place`` of the tables of a schema, by one command."""
    shown = spark.sql(f"SHOW TABLE EXTENDED IN `{schema}` LIKE '*'").filter(~F.col("isTemporary"))
    said = lambda name: F.regexp_extract("information", f"(?m)^{name}: (.*)$", 1)
    return shown.select(F.col("tableName").alias("table_name"), said("Provider").alias("provider"), said("Location").alias("place"))


def probe_tables(spark: SparkSession, schema: str, limit: int = 50) -> DataFrame:
    """Row count, size and last change of each table, latest first.

    The files of a table give its size and age, Parquet footers its row count; no column is read.
    The plan does not grow with the tables: only views, and tables that are not of Parquet files
    or lie where tasks open nothing, are counted one by one.
    """
    tables = described_tables(spark, schema)
    readable = is_readable(F.col("provider"), F.col("place"))
    probes = footer_statistics(tables.where(readable))
    for row in tables.where(~readable).collect():
        probes = probes.unionByName(probe_table(spark, schema, row["table_name"]))
    return probes.orderBy(F.col("last_altered").desc_nulls_last(), "table_name").limit(limit)


def probe_table(spark: SparkSession, schema: str, name: str) -> DataFrame:
    detail = {
        r["col_name"]: r["data_type"]
        for r in spark.sql(f"DESCRIBE TABLE EXTENDED `{schema}`.`{name}`").filter("col_name = 'Location'").collect()
    }
    rows = spark.table(f"`{schema}`.`{name}`").agg(F.count(F.lit(1)).alias("row_count"))
    if "Location" not in detail:
        return rows.select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(None).cast("bigint").alias("bytes"),
            F.lit(None).cast("timestamp").alias("created"),
            F.lit(None).cast("timestamp").alias("last_altered"),
        )
    stats = read_files(spark, detail["Location"]).agg(
        F.struct(
            F.sum("length").alias("bytes"),
            F.min("modificationTime").alias("created"),
            F.max("modificationTime").alias("last_altered"),
        ).alias("s")
    )
    scalar = stats.scalar()
    return rows.select(
        F.lit(name).alias("table_name"),
        "row_count",
        scalar.getField("bytes").alias("bytes"),
        scalar.getField("created").alias("created"),
        scalar.getField("last_altered").alias("last_altered"),
    )
