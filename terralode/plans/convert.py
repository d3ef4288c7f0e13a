"""Raw files to one Parquet table each."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from itertools import islice
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from terralode.functions.names import table_name
from terralode.operators.catalog import ledger_additions, new_files
from terralode.plans.runner import RESULT_SCHEMA, run_each
from terralode.plans.together import FORMATS, convert_together
from terralode.session import local_rows, shared_dir
from terralode.sinks.parquet import append_to_ledger, write_table
from terralode.sources.archive import read_archives, save_members, stage_members
from terralode.sources.folders import list_every_object
from terralode.sources.listing import if_exists, list_keys, list_objects, literal_path, relative_key, source_path
from terralode.sources.registry import (
    MEMBER_EXTENSIONS,
    PARQUET_EXTENSIONS,
    TEXT_EXTENSIONS,
    TRANSPARENT,
    extension_of,
    must_unpack,
    output_name,
    read_member,
    read_tables,
    stem_of,
)
from terralode.sources.stores import tasks_can_open
from terralode.sources.tabular import read_csv

LEDGER_SCHEMA = "key string"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Keys processed so far; empty before the first run."""
    held = if_exists(lambda: spark.read.schema(LEDGER_SCHEMA).parquet(path))
    return local_rows(spark, [], LEDGER_SCHEMA) if held is None else held


def convert_file(spark: SparkSession, source: str, target: str, prefix_with_stem: bool = True) -> list[str]:
    """Write every table of a file as ``<target>/<name>.parquet``; returns the names.

    ``prefix_with_stem`` puts the file's name before that of a sheet or table, so that
    equal ones of two files do not overwrite one another.
    """
    written, stem = [], output_name(source)
    for name, df in read_tables(spark, source).items():
        if prefix_with_stem and name != stem and not must_unpack(source):
            name = f"{stem}_{name}"
        write_table(df, f"{target}/{name}.parquet")
        written.append(name)
    return written


def convert_archives(spark: SparkSession, source: str, keys: list[str], target: str, workers: int = 7) -> DataFrame:
    """Convert the members of the archives with the given keys under a source.

    All archives are opened by one job. Each gives a row for itself and one per
    member, whose key is the archive's and the member's.
    """
    archives = read_archives(spark, [literal_path(f"{source.rstrip('/')}/{key}") for key in keys])
    members = save_members(archives, shared_dir(spark, "members"))
    staged = stage_members(members, TEXT_EXTENSIONS, PARQUET_EXTENSIONS)
    key = relative_key(source, F.col("archive")).alias("key")
    rows = members.filter("part = 0 or error is not null").select(key, "member", "ext", "table", "error").collect()
    whole = {key: (key, None, True, None) for key in keys}
    unread, todo = {}, {}
    for row in rows:
        name = f"{row['key']}!{row['member']}"
        if row["member"] is None:
            whole[row["key"]] = (row["key"], None, False, row["error"])
        elif row["error"] or row["ext"] not in MEMBER_EXTENSIONS:
            unread[name] = (name, None, False, row["error"] or f"no reader for .{row['ext']}")
        else:
            todo[name] = (row["ext"], row["table"])
    # A member some part of which could not be read is not converted at all.
    todo = {name: place for name, place in todo.items() if name not in unread}

    together, alone = convert_members(spark, staged, todo, target, workers)
    faulty = {name for name, row in unread.items() if not row[3].startswith("no reader")}

    def convert(name: str) -> list[str]:
        written = []
        for table, df in read_member(spark, members, staged, *todo[name]).items():
            write_table(df, f"{target}/{table}.parquet")
            written.append(table)
        return written

    converted = run_each(spark, alone, convert, workers).unionByName(local_rows(spark, together, RESULT_SCHEMA))
    for row in converted.filter("not ok").select("key").collect():
        faulty.add(row["key"])
    for name in faulty:
        archive = name.partition("!")[0]
        if whole[archive][2]:
            whole[archive] = (archive, None, False, "a member failed")
    return converted.unionByName(local_rows(spark, [*whole.values(), *unread.values()], RESULT_SCHEMA))


def convert_members(
    spark: SparkSession, staged: str, todo: dict[str, tuple[str, str]], target: str, workers: int
) -> tuple[list[tuple[str, str | None, bool, str | None]], list[str]]:
    """Convert the staged text members that are one file each, all of a format at once; and the names of all others."""
    if not any(ext in FORMATS for ext, _ in todo.values()):
        return [], sorted(todo)
    place = F.regexp_extract("key", "^ext=[^/]*/table=([^/]*)/", 1).alias("table")
    files = list_keys(spark, staged).groupBy(place).agg(F.count("*").alias("n"), F.min("key").alias("key")).where("n = 1").collect()
    at = {unquote(r["table"]): r["key"] for r in files}
    names = {at[table]: name for name, (ext, table) in todo.items() if ext in FORMATS and table in at}
    tables = {key: stem_of(todo[name][1]) for key, name in names.items()}
    rows, _ = convert_formats(spark, staged, tables, {key: todo[name][0] for key, name in names.items()}, target, workers)
    done = [(names[key], *rest) for key, *rest in rows]
    taken = {name for name, *_ in done}
    return done, sorted(name for name in todo if name not in taken)


def convert_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    ledger: str,
    workers: int = 7,
    files_at_once: int = 1000,
) -> DataFrame:
    """Convert what the ledger does not hold yet, adding to it what succeeded.

    Files are taken some at a time, and the ledger and the results are written after
    each lot: a run that breaks off goes on where it stopped, and the driver holds
    the names of one lot. All text files of a format are converted by a few jobs, as
    many as they have layouts (see ``convert_together``); files of other formats are
    independent jobs run side by side. All archives of a lot are opened together by
    one. An archive is done, and in the ledger, unless a member failed. Every file of the
    source is listed (on a file system tasks can open); an empty one, and one whose name Spark's readers pass over, gives a
    result row saying so.
    """
    listed = (list_every_object if tasks_can_open(source) else list_objects)(spark, source).select("key", "size_bytes")
    todo = new_files(listed, read_ledger(spark, ledger)).orderBy("key")
    results = shared_dir(spark, "results")
    local_rows(spark, [], RESULT_SCHEMA).write.parquet(results)
    files = ((row["key"], row["size_bytes"]) for row in todo.toLocalIterator())
    while of_files := list(islice(files, files_at_once)):
        refused = {key: why for key, size in of_files if (why := why_refused(key, size))}
        lot = [key for key, _ in of_files if key not in refused]
        told = local_rows(spark, [(key, None, False, why) for key, why in refused.items()], RESULT_SCHEMA)
        rows = convert_lot(spark, source, lot, target, workers).unionByName(told)
        rows.write.mode("append").parquet(results)
        of_lot = local_rows(spark, [(key,) for key in lot], LEDGER_SCHEMA)
        done = rows.filter("ok").select("key").join(of_lot, "key", "left_semi")
        append_to_ledger(ledger_additions(read_ledger(spark, ledger), done), ledger)
    return spark.read.schema(RESULT_SCHEMA).parquet(results)


def why_refused(key: str, size: int) -> str | None:
    """Why a file cannot be converted, going by its name and size."""
    name = key.rsplit("/", 1)[-1]
    if size == 0:
        return "an empty file"
    if name.startswith(".") or name.startswith("_") and "=" not in name:
        return "a name Spark's readers pass over"
    return None


def convert_lot(spark: SparkSession, source: str, keys: list[str], target: str, workers: int) -> DataFrame:
    """Convert the files with the given keys: all of a format in a few jobs, the others side by side."""
    root = source.rstrip("/")
    plain = [key for key in keys if not must_unpack(key)]
    archives = [key for key in keys if must_unpack(key)]
    rows, alone = convert_formats(spark, root, {key: output_name(key) for key in plain}, {key: format_of(key) for key in plain}, target, workers)
    convert = lambda key: convert_file(spark, f"{root}/{key}", target)
    results = run_each(spark, alone, convert, workers, lane=output_name).unionByName(local_rows(spark, rows, RESULT_SCHEMA))
    if archives:
        results = results.unionByName(convert_archives(spark, source, archives, target, workers))
    return results


def convert_formats(
    spark: SparkSession, root: str, tables: dict[str, str], formats: dict[str, str], target: str, workers: int
) -> tuple[list[tuple[str, str | None, bool, str | None]], list[str]]:
    """Convert the files whose format takes many at once, given by key with their table and format.

    Returns their result rows, and the keys of all others: files that share a table's
    name, which are taken in turn, and those of a lot whose jobs failed, so that the
    file at fault is found.
    """
    named = Counter(tables.values())
    many: dict[str, list[str]] = {}
    for key, ext in formats.items():
        if named[tables[key]] == 1 and ext in FORMATS:
            many.setdefault(ext, []).append(key)

    def convert_all(ext: str) -> dict[str, str | None]:
        try:
            return convert_together(spark, root, {key: tables[key] for key in many[ext]}, ext, target)
        except Exception:
            return {}

    with ThreadPoolExecutor(max_workers=workers) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(convert_all), many))
    outcome = {key: error for done in found for key, error in done.items()}
    rows = [(key, None if error else tables[key], error is None, error) for key, error in outcome.items()]
    return rows, sorted(key for key in tables if key not in outcome)


def format_of(key: str) -> str:
    """Extension of a file, or of the text a compression Hadoop undoes holds."""
    ext = extension_of(key)
    return extension_of(stem_of(key)) if ext in TRANSPARENT else ext


def convert_same_layout(
    spark: SparkSession, paths: list[str], target: str, read: Callable[..., DataFrame] = read_csv
) -> str:
    """Convert many files of one layout in one job, a ``table=<name>`` folder per file.

    The files share their column types. One job takes the place of one per file,
    and the rebalance splits the rows of a large file over several tasks.
    """
    rows = read(spark, paths).withColumn("table", table_name(source_path()))
    rows.hint("rebalance", "table").write.mode("overwrite").partitionBy("table").parquet(target)
    return target
