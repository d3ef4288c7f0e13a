"""Delimited text and Parquet."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from terralode.functions.cleaning import NA_TOKENS, na_to_null, named
from terralode.functions.names import unique_names
from terralode.operators.infer import (
    apply_types,
    inferred_type,
    kind_counts,
    name_at,
    null_tokens_to_null,
    type_columns,
    value_kind,
)
from terralode.operators.quality import assert_rows
from terralode.sources.splits import DelimitedLines, read_records

# Separators looked for in a header line, the likeliest first.
SEPARATORS = [",", "\t", ";", " ", ":", "|"]


def odd_quotes(line: Column) -> Column:
    """Whether a line ends inside a quoted field, so that its record goes on in the next."""
    quotes = F.length(line) - F.length(F.translate(line, '"', ""))
    return line.contains('"') & (quotes % 2 == 1)


def text_lines(spark: SparkSession, path: str | list[str], encoding: str) -> DataFrame:
    """Lines that are not blank; a delimited reader skips the others too. Wrong bytes fail the job."""
    lines = spark.read.text(path)
    if encoding.upper() in ("UTF-8", "UTF8"):
        value = F.validate_utf8("value")
    else:
        value = F.decode(F.col("value").cast("binary"), encoding)
    return lines.select(value.alias("value")).filter(F.trim("value") != "")


def first_line(spark: SparkSession, path: str | list[str], encoding: str) -> str | None:
    row = text_lines(spark, path, encoding).first()
    return row["value"] if row else None


def sniff_separator(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str:
    """The separator of a text file, from its header line."""
    outside_quotes = "".join((first_line(spark, path, encoding) or "").split('"')[::2])
    return next((s for s in SEPARATORS if s in outside_quotes), ",")


def csv_options(sep: str, encoding: str, multi_line: bool) -> dict[str, object]:
    return {
        "sep": sep,
        "quote": '"',
        "escape": '"',
        "multiLine": multi_line,
        "encoding": encoding,
        "nullValue": "",
        "emptyValue": "",
    }


def header_names(spark: SparkSession, path: str | list[str], sep: str, encoding: str) -> tuple[str | None, list[str]]:
    """The header line and the names in it; no line when the header itself holds a line break."""
    line = first_line(spark, path, encoding)
    case_sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"
    if line is None:
        return None, []
    if line.count('"') % 2 == 0:
        return line, unique_names(next(csv.reader([line], delimiter=sep)), case_sensitive)
    record = spark.read.options(**csv_options(sep, encoding, True)).csv(path).first()
    return None, unique_names(list(record), case_sensitive)


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_delimited_text(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    multi_line: bool = True,
    encoding: str = "UTF-8",
    names: list[str] | None = None,
) -> DataFrame:
    """Every column as text, named by the header. With ``multi_line`` a record may go over several lines.

    Files are read in splits either way. A record with more fields than the header has
    names fails the job, and so does a quoted field that does not end.
    """
    if names is None:
        names = header_names(spark, path, sep, encoding)[1]
    spare = unique_names([*names, "_surplus"])[-1]
    if multi_line:
        records = read_records(spark, path, DelimitedLines(sep))
        if records.broken:
            raise ValueError(f"a quoted field that does not end: {', '.join(records.broken)}")
        text = parsed_records(records.rows.where("block <> 0 or nth <> 0"), [*names, spare], sep, encoding).select("r.*")
    else:
        reader = spark.read.options(**csv_options(sep, encoding, False)).options(header=True, enforceSchema=True)
        text = reader.schema(text_schema([*names, spare])).csv(path)
    return assert_rows(text, named(spare).isNull(), f"more fields than names in the header: {path}").drop(spare)


def parsed_records(records: DataFrame, names: list[str], sep: str, encoding: str) -> DataFrame:
    """Records with their fields as texts, a struct ``r``. Wrong bytes fail the job."""
    if encoding.upper() in ("UTF-8", "UTF8"):
        value = F.validate_utf8(F.col("record").cast("string"))
    else:
        value = F.decode("record", encoding)
    return records.withColumn("r", F.from_csv(value, text_schema(names).toDDL(), text_options(sep)))


def text_options(sep: str) -> dict[str, str]:
    return {k: str(v) for k, v in csv_options(sep, "UTF-8", False).items() if k not in ("multiLine", "encoding")}


def line_profile(
    spark: SparkSession, path: str | list[str], sep: str, encoding: str, header: str, names: list[str], na_tokens: list[str]
) -> tuple[dict[str, str], int, int]:
    """Column types, lines that end inside quotes, and header lines, from one splittable pass."""
    value = F.col("value")
    lines = text_lines(spark, path, encoding).select(
        (value == header).alias("is_header"),
        odd_quotes(value).alias("odd"),
        F.from_csv("value", text_schema(names).toDDL(), text_options(sep)).alias("r"),
    )
    # The values of a line one under the other: the plan does not grow with the columns.
    fields = F.array(*[F.col("r").getField(n) for n in names])
    values = lines.select("is_header", "odd", F.posexplode(fields).alias("i", "v"))
    kinds = values.withColumn("v", na_to_null(F.col("v"), na_tokens)).select(
        "is_header", "odd", "i", F.when(~F.col("is_header"), value_kind(F.col("v"))).alias("k")
    )
    found = kinds.groupBy("i").agg(
        F.count_if(~F.col("is_header")).alias("n_rows"),
        *kind_counts(),
        F.count_if("odd").alias("odd"),
        F.count_if("is_header").alias("headers"),
    )
    rows = found.select(name_at(names, "i"), inferred_type().alias("data_type"), "odd", "headers").collect()
    return {r["column_name"]: r["data_type"] for r in rows}, rows[0]["odd"], rows[0]["headers"]


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str | None = ",",
    schema: str | T.StructType | None = None,
    na_tokens: list[str] = NA_TOKENS,
    multi_line: bool | None = None,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Delimited text with typed columns; ``sep=None`` looks for the separator.

    One pass over the lines settles the types and whether any record goes over
    several lines; only then are records cut out first. Files are read in splits
    either way. A given ``schema`` with ``multi_line`` saves that pass.
    """
    if sep is None:
        sep = sniff_separator(spark, path, encoding)
    header, names = header_names(spark, path, sep, encoding)
    if not names:
        return spark.createDataFrame([], T.StructType() if schema is None else schema)
    if schema is not None:
        if multi_line is None:
            multi_line = not text_lines(spark, path, encoding).filter(odd_quotes(F.col("value"))).isEmpty()
        text = read_delimited_text(spark, path, sep, multi_line, encoding, names)
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        return text.select([na_to_null(named(f.name), na_tokens).try_cast(f.dataType).alias(f.name) for f in wanted])
    if multi_line is None and header is not None:
        types, odd, headers = line_profile(spark, path, sep, encoding, header, names, na_tokens)
        text = read_delimited_text(spark, path, sep, odd > 0, encoding, names)
        # A line equal to the header further down is data the profile has left out.
        if odd == 0 and headers == len(text.inputFiles()):
            return apply_types(null_tokens_to_null(text, na_tokens), types)
        return type_columns(text, na_tokens)
    return type_columns(read_delimited_text(spark, path, sep, multi_line is not False, encoding, names), na_tokens)


def read_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_delimited(spark, path, sep=",", **options)


def read_tsv(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_delimited(spark, path, sep="\t", **options)


def read_txt(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_delimited(spark, path, sep=None, **options)


def read_parquet(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Parquet as it is; ``glob="*.pq"`` picks the alias out of a folder."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)
