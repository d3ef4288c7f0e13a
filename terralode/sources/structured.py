"""JSON, XML, GeoJSON and KML."""

from __future__ import annotations

from collections.abc import Sequence
from operator import itemgetter

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from terralode.functions.cleaning import NA_TOKENS, named
from terralode.operators.clean import stringify_objects
from terralode.operators.flatten import (
    KML_SCHEMA,
    describe_geometry,
    expand_features,
    json_objects_to_columns,
    placemark_rows,
)
from terralode.operators.infer import type_columns
from terralode.sources.splits import JsonElements, XmlElements, read_records


def read_json(spark: SparkSession, path: str, lines: bool = False, schema: str | T.StructType | None = None) -> DataFrame:
    """Records of a JSON array, or one record per line; nested values become JSON text. Broken JSON fails.

    An array is read in splits. A file that is one object is one record, unless its values are
    all objects or all arrays: these are columns then, their keys or places the rows. Names
    that differ only in case get numbers.
    """
    if lines:
        reader = spark.read.option("mode", "FAILFAST")
        return stringify_objects((reader if schema is None else reader.schema(schema)).json(path))
    found = read_records(spark, path, JsonElements())
    texts = found.texts()
    if found.single:
        of_one = F.col("path").isin(found.single)
        texts = texts.where(~of_one).union(texts.where(of_one).select("path", F.explode(rows_of_columns("text"))))
    return json_table(texts, schema)


def json_table(texts: DataFrame, schema: str | T.StructType | None = None) -> DataFrame:
    """The table of ``text`` rows that are one JSON object each; one that does not parse fails."""
    if schema is not None:
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        return stringify_objects(texts.select(F.from_json("text", wanted, {"mode": "FAILFAST"}).alias("r")).select("r.*"))
    # The parser of the strict kind stops at the first text that is none.
    strict = texts.select(F.when(F.parse_json("text").isNotNull(), F.col("text")).alias("text"))
    return stringify_objects(json_objects_to_columns(strict, "text"))


def rows_of_columns(text: str) -> Column:
    """JSON objects, one per row, of an object of columns; any other object is its own row."""
    columns = F.parse_json(text).cast("map<string, variant>")
    kinds = F.transform(F.map_values(columns), lambda v: F.schema_of_variant(v))
    all_of = lambda kind: (F.size(kinds) > 0) & F.forall(kinds, lambda k: k.startswith(kind))
    by_key = F.transform_values(columns, lambda _, v: F.try_variant_get(v, "$", "map<string, variant>"))
    by_place = F.transform_values(columns, lambda _, v: F.try_variant_get(v, "$", "array<variant>"))
    keys = F.array_distinct(F.flatten(F.transform(F.map_values(by_key), F.map_keys)))
    places = F.array_max(F.transform(F.map_values(by_place), F.size))
    return (
        F.when(all_of("OBJECT"), F.transform(keys, lambda k: F.to_json(F.transform_values(by_key, lambda _, v: F.try_element_at(v, k)))))
        .when(all_of("ARRAY") & (places == 0), F.array().cast("array<string>"))
        .when(all_of("ARRAY"), F.transform(F.sequence(F.lit(0), places - 1), lambda i: F.to_json(F.transform_values(by_place, lambda _, v: F.get(v, i)))))
        .otherwise(F.array(F.col(text)))
    )


def row_tag(xpath: str) -> str:
    """The element an XPath of the form ``.//tag`` names."""
    tag = xpath.removeprefix(".").lstrip("/")
    if not tag or "/" in tag or "[" in tag:
        raise ValueError(f"only paths of the form .//tag are read: {xpath}")
    return tag


XML_OPTIONS = {"attributePrefix": "", "mode": "FAILFAST"}


def read_xml(
    spark: SparkSession,
    path: str,
    xpath: str = ".//record",
    schema: str | T.StructType | None = None,
    na_tokens: list[str] = NA_TOKENS,
) -> DataFrame:
    """One row per matching element; attributes and child elements become columns.

    Files are read in splits. A broken element fails, and so does a file that is not closed.
    """
    tag = row_tag(xpath)
    return xml_table(read_records(spark, path, XmlElements(tag)).texts(), tag, schema, na_tokens)


def xml_table(texts: DataFrame, tag: str, schema: str | T.StructType | None = None, na_tokens: list[str] = NA_TOKENS) -> DataFrame:
    """The table of ``text`` rows that are one element each."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if wanted is None:
        rows = texts.select("text").rdd.map(itemgetter(0))
        wanted = texts.sparkSession.read.options(inferSchema=False, **XML_OPTIONS).xml(rows, rowTag=tag).schema
    if not wanted.fields:
        return texts.select()
    raw = stringify_objects(texts.select(F.from_xml("text", wanted, {"rowTag": tag, **XML_OPTIONS}).alias("r")).select("r.*"))
    return raw if schema is not None else type_columns(raw, na_tokens)


def read_geojson(spark: SparkSession, path: str, expand: bool = True) -> DataFrame:
    """One row per feature of feature collections, read in splits, or of a file that is one feature.

    Geometry stays GeoJSON text; ``expand`` gives every property a column. A file that is neither fails.
    """
    return feature_table(read_records(spark, path, JsonElements(features=True)).texts(), expand)


def feature_table(texts: DataFrame, expand: bool = True) -> DataFrame:
    """The table of ``text`` rows, one object each."""
    features = feature_rows(texts)
    return expand_features(features) if expand else features


def feature_rows(texts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Features of ``text`` rows; what is none, as of other members of a collection, is left out."""
    parsed = texts.select(*keep, F.from_json("text", "type string, properties string, geometry string", {"mode": "FAILFAST"}).alias("f"))
    return describe_geometry(parsed.where("f.type = 'Feature'").select(*keep, "f.properties", "f.geometry"))


def read_geojson_lines(spark: SparkSession, path: str, expand: bool = True) -> DataFrame:
    """One feature per line: the form of GeoJSON a large file can be split in."""
    lines = spark.read.option("mode", "FAILFAST").schema("properties string, geometry string").json(path)
    features = describe_geometry(lines)
    return expand_features(features) if expand else features


def read_kml(spark: SparkSession, path: str) -> DataFrame:
    """One row per placemark, whatever its folder; files are read in splits."""
    return placemark_table(read_records(spark, path, XmlElements("Placemark")).texts())


def placemark_table(texts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    parsed = texts.select(*map(named, keep), F.from_xml("text", T.StructType.fromDDL(KML_SCHEMA), {"rowTag": "Placemark", "mode": "FAILFAST"}).alias("p"), F.col("text").alias("_xml"))
    return placemark_rows(parsed.select(*map(named, keep), "p.*", "_xml"), keep, text="_xml")
