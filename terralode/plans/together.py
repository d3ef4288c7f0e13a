"""Many files of one format to their tables at once: the jobs grow with the layouts, not with the files.

All files of a format are profiled by one job, keyed by file and column. Files whose names and
types agree make one layout, read and written by one job, and each file's rows land in a
folder that is then moved to its table's place. A file that cannot be read is told of by the
profile and left out.
"""

from __future__ import annotations

import csv
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from terralode.functions.cleaning import NA_TOKENS, na_to_null, named
from terralode.functions.names import unique_names
from terralode.operators.flatten import object_schemas, objects_as
from terralode.operators.infer import apply_types, inferred_type, kind_counts, null_tokens_to_null, value_kind
from terralode.session import local_rows
from terralode.sinks.parquet import move_folder, remove_folder, write_table
from terralode.sources.listing import literal_path, relative_key, source_path
from terralode.sources.splits import DelimitedLines, JsonElements, XmlElements, read_records
from terralode.sources.structured import feature_rows, placemark_table, rows_of_columns
from terralode.sources.tabular import SEPARATORS, csv_options, odd_quotes, parsed_records, text_schema

FORMATS = ("csv", "tsv", "txt", "json", "jsonl", "geojson", "kml")


# The column of a file's key: a name no file has.
KEY = f"file-{uuid.uuid4().hex}"


@dataclass
class Layout:
    """Files of one layout: their rows, with the file's key in the column ``KEY``."""

    keys: list[str]
    rows: DataFrame


Found = tuple[list[Layout], dict[str, str]]


def paths_of(root: str, keys: list[str]) -> list[str]:
    return [literal_path(f"{root}/{key}") for key in keys]


def key_of(root: str, path: str) -> str:
    return path.split(root.split(":", 1)[-1].lstrip("/") + "/", 1)[-1]


# Delimited text


def delimited_layouts(spark: SparkSession, root: str, keys: list[str], ext: str, na_tokens: list[str] = NA_TOKENS) -> Found:
    """Header, separator and quoting of every file by one job, types by another."""
    lines = spark.read.text(paths_of(root, keys)).where(F.trim("value") != "")
    lines = lines.select(relative_key(root, source_path()).alias("key"), "value", F.monotonically_increasing_id().alias("nth"), F.col("_metadata.file_block_start").alias("block"))
    first = F.min_by("value", F.when(F.col("block") == 0, F.col("nth")))
    looks = lines.groupBy("key").agg(first.alias("header"), F.count_if(odd_quotes(F.col("value"))).alias("odd"), F.count_if(~F.is_valid_utf8("value")).alias("wrong"))
    errors = dict.fromkeys(keys, ALONE)
    files: dict[tuple[str, bool], dict[str, list[str]]] = {}
    case_sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"
    for row in looks.collect():
        if row["wrong"]:
            errors[row["key"]] = "bytes that are not UTF-8"
            continue
        if row["header"].count('"') % 2:
            errors[row["key"]] = ALONE
            continue
        sep = {"csv": ",", "tsv": "\t"}.get(ext) or next((s for s in SEPARATORS if s in "".join(row["header"].split('"')[::2])), ",")
        names = unique_names(next(csv.reader([row["header"]], delimiter=sep)), case_sensitive)
        files.setdefault((sep, row["odd"] > 0), {})[row["key"]] = names
        del errors[row["key"]]
    layouts: dict[tuple, list[str]] = {}
    for (sep, over_lines), names in files.items():
        found, failed = typed_files(spark, root, names, sep, over_lines, na_tokens)
        errors |= failed
        for key, types in found.items():
            layouts.setdefault((sep, over_lines, tuple(names[key]), types), []).append(key)
    made = []
    for (sep, over_lines, names, types), held in layouts.items():
        rows = fields_of(spark, root, held, sep, over_lines, len(names))
        columns = [F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(names)]
        texts = null_tokens_to_null(rows.select(F.col("key").alias(KEY), *columns), na_tokens, names)
        made.append(Layout(held, apply_types(texts, dict(zip(names, types)))))
    return made, errors


# The job for all files leaves these to one of their own.
ALONE = "to be read alone"


def fields_of(spark: SparkSession, root: str, keys: list[str], sep: str, over_lines: bool, width: int) -> DataFrame:
    """``key, fields`` of every record but the headers: so many texts, and one more that should be null."""
    names = [f"c{i}" for i in range(width + 1)]
    paths = paths_of(root, keys)
    if over_lines:
        records = read_records(spark, paths, DelimitedLines(sep))
        if records.broken:
            raise ValueError(f"a quoted field that does not end: {', '.join(records.broken)}")
        parsed = parsed_records(records.rows.where("block <> 0 or nth <> 0"), names, sep, "UTF-8")
        return parsed.select(relative_key(root, F.col("path")).alias("key"), F.array(*[F.col("r").getField(n) for n in names]).alias("fields"))
    reader = spark.read.options(**csv_options(sep, "UTF-8", False)).options(header=True, enforceSchema=True)
    rows = reader.schema(text_schema(names)).csv(paths)
    return rows.select(relative_key(root, source_path()).alias("key"), F.array(*names).alias("fields"))


def typed_files(
    spark: SparkSession, root: str, names: dict[str, list[str]], sep: str, over_lines: bool, na_tokens: list[str]
) -> tuple[dict[str, tuple[str, ...]], dict[str, str]]:
    """Column types of each file, from one profile keyed by file and column; and the files with surplus fields."""
    widths = F.broadcast(local_rows(spark, [(k, len(n)) for k, n in names.items()], "key string, width int"))
    rows = fields_of(spark, root, list(names), sep, over_lines, max(map(len, names.values()))).join(widths, "key")
    # The place after the last name stands for all that is there.
    values = rows.select("key", "width", F.posexplode(F.slice("fields", F.lit(1), F.col("width") + 1)).alias("i", "v"))
    kinds = values.select("key", "i", "width", F.when(F.col("i") < F.col("width"), value_kind(na_to_null(F.col("v"), na_tokens))).alias("k"), F.lit(1).alias("n"), ((F.col("i") == F.col("width")) & F.col("v").isNotNull()).alias("surplus"))
    none = local_rows(spark, [(k, i, len(n)) for k, n in names.items() for i in range(len(n))], "key string, i int, width int")
    kinds = kinds.union(none.select("key", "i", "width", F.lit(None).cast("int"), F.lit(0), F.lit(False)))
    profile = kinds.groupBy("key", "i").agg(F.sum("n").alias("n_rows"), *kind_counts(), F.max("surplus").alias("surplus"))
    found: dict[str, dict[int, str]] = {}
    errors: dict[str, str] = {}
    for row in profile.select("key", "i", inferred_type().alias("type"), "surplus").collect():
        if row["surplus"]:
            errors[row["key"]] = "more fields than names in the header"
        found.setdefault(row["key"], {})[row["i"]] = row["type"]
    return {k: tuple(types[i] for i in range(len(names[k]))) for k, types in found.items() if k not in errors}, errors


# JSON and GeoJSON


def json_layouts(spark: SparkSession, root: str, keys: list[str], ext: str) -> Found:
    """Column types of all files from one aggregate keyed by file."""
    errors = {}
    if ext == "jsonl":
        texts = spark.read.text(paths_of(root, keys)).where(F.trim("value") != "").select(source_path().alias("path"), F.col("value").alias("text"))
    else:
        records = read_records(spark, paths_of(root, keys), JsonElements(features=ext == "geojson"))
        errors = {key_of(root, path): "malformed or not complete" for path in records.broken}
        texts = records.rows.select("path", F.col("record").cast("string").alias("text"))
        if ext == "json" and records.single:
            one = F.col("path").isin(records.single)
            texts = texts.where(~one).union(texts.where(one & F.try_parse_json("text").isNotNull()).select("path", F.explode(rows_of_columns("text"))))
    texts = texts.select(relative_key(root, F.col("path")).alias("key"), "text")
    wrong = F.count_if(F.try_parse_json("text").isNull() | ~F.is_valid_utf8("text")).alias("wrong")
    errors |= {r["key"]: "malformed JSON" for r in texts.groupBy("key").agg(wrong).where("wrong > 0").collect()}
    texts = texts.where(~F.col("key").isin(list(errors))) if errors else texts
    given, column, fixed = texts, "text", []
    if ext == "geojson":
        given, column, fixed = feature_rows(texts, ["key"]), "properties", ["geometry", "geometry_type", "lon", "lat"]
    schemas = object_schemas(given, column, ["key"])
    groups: dict[str | None, list[str]] = {}
    for row in schemas.collect():
        groups.setdefault(row["found"], []).append(row["key"])
    # Files without a record are told by no row.
    seen = {key for held in groups.values() for key in held}
    if without := [key for key in keys if key not in seen and key not in errors]:
        groups.setdefault(None, []).extend(without)
    made = []
    for found, held in groups.items():
        if found is not None and not found.startswith("OBJECT<"):
            errors |= dict.fromkeys(held, ALONE)
            continue
        mine = given.where(F.col("key").isin(held)).withColumnRenamed("key", KEY)
        made.append(Layout(held, objects_as(mine, column, found, [KEY, *fixed], apart=[KEY])))
    return made, errors


def kml_layouts(spark: SparkSession, root: str, keys: list[str], ext: str) -> Found:
    records = read_records(spark, paths_of(root, keys), XmlElements("Placemark"))
    errors = {key_of(root, path): "malformed or not complete" for path in records.broken}
    texts = records.rows.select(relative_key(root, F.col("path")).alias(KEY), F.validate_utf8(F.col("record").cast("string")).alias("text"))
    return [Layout([k for k in keys if k not in errors], placemark_table(texts, [KEY]))], errors


LAYOUTS: dict[str, Callable[..., Found]] = {
    **dict.fromkeys(("csv", "tsv", "txt"), delimited_layouts),
    **dict.fromkeys(("json", "jsonl", "geojson"), json_layouts),
    "kml": kml_layouts,
}


def convert_together(spark: SparkSession, root: str, tables: dict[str, str], ext: str, target: str) -> dict[str, str | None]:
    """Convert the files of a format, given by key with the name of their table, as ``convert_file`` would each.

    Returns each file's error, null where its table is written; a key that is not in it is to
    be converted alone. Keys are below ``root``, and no two tables have one name.
    """
    layouts, errors = LAYOUTS[ext](spark, root, sorted(tables), ext)
    outcome: dict[str, str | None] = {key: error for key, error in errors.items() if error != ALONE}
    for layout in layouts:
        if layout.rows.columns == [KEY]:
            outcome |= dict.fromkeys(layout.keys, "a file without columns")
        elif layout.keys:
            write_layout(spark, layout, tables, target)
            outcome |= dict.fromkeys(layout.keys)
    return outcome


def write_layout(spark: SparkSession, layout: Layout, tables: dict[str, str], target: str) -> None:
    """One write for all files of a layout, then each file's folder moved to its table's place."""
    numbers = {key: n for n, key in enumerate(layout.keys)}
    number = unique_names([*layout.rows.columns, "_n"])[-1]
    numbered = layout.rows.join(F.broadcast(local_rows(spark, list(numbers.items()), f"`{KEY}` string, `{number}` int")), KEY).drop(KEY)
    # Next to the tables, so that moving them is a step of one file system; hidden from listings.
    staged = f"{target}/_layout-{uuid.uuid4().hex}"
    write_table(numbered.hint("rebalance", number), staged, partition_by=number)
    empty = numbered.drop(number).limit(0)
    for key, n in numbers.items():
        place = f"{target}/{tables[key]}.parquet"
        if not move_folder(spark, f"{staged}/{number}={n}", place):
            write_table(empty, place)
    remove_folder(spark, staged)
