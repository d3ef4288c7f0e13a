"""Documents, rasters, features and ragged records to plain rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from terralode.functions.cleaning import named
from terralode.functions.markup import placemark_geometry
from terralode.functions.measures import char_count, is_blank, pixel_centre, word_count
from terralode.functions.names import unique_names
from terralode.functions.nested import coordinates
from terralode.operators.clean import attach_constants

FEATURES_SCHEMA = "features array<struct<properties string, geometry string>>"


def paragraphs(df: DataFrame, text: str = "text", keep: Sequence[str] = (), sep: str = "\n") -> DataFrame:
    """One row per paragraph that is not blank; the number counts the blank ones too."""
    rows = df.select(*[named(k) for k in keep], F.posexplode(F.split(named(text), sep)).alias("pos", "text"))
    return paragraph_columns(rows, keep)


def text_paragraphs(df: DataFrame, items: str = "paragraphs", keep: Sequence[str] = ()) -> DataFrame:
    """Paragraph rows of documents given as arrays of texts."""
    return paragraph_columns(df.select(*[named(k) for k in keep], F.posexplode(named(items)).alias("pos", "text")), keep)


def paragraph_columns(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Number, text and counts from ``pos`` (0-based) and ``text``, blank paragraphs dropped."""
    return rows.filter(~is_blank(F.col("text"))).select(
        *[named(k) for k in keep],
        (F.col("pos") + 1).alias("paragraph_number"),
        "text",
        char_count(F.col("text")).alias("char_count"),
        word_count(F.col("text")).alias("word_count"),
    )


def styled_paragraphs(df: DataFrame, items: str = "paragraphs", keep: Sequence[str] = ()) -> DataFrame:
    """Paragraph rows of documents given as arrays of ``(text, style)``, the style kept."""
    rows = df.select(*[named(k) for k in keep], F.posexplode(named(items)).alias("pos", "item"))
    flat = rows.select(*[named(k) for k in keep], "pos", "item.text", "item.style")
    numbered = paragraph_columns(flat, [*keep, "style"])
    return numbered.select(*[named(k) for k in keep], "paragraph_number", "text", "style", "char_count", "word_count")


def pages(df: DataFrame, text: str = "text", keep: Sequence[str] = (), sep: str = "\f") -> DataFrame:
    """One row per page, blank pages included."""
    rows = df.select(*[named(k) for k in keep], F.posexplode(F.split(named(text), sep)).alias("pos", "text"))
    return rows.select(
        *[named(k) for k in keep],
        (F.col("pos") + 1).alias("page_number"),
        "text",
        char_count(F.col("text")).alias("char_count"),
        word_count(F.col("text")).alias("word_count"),
    )


def raster_pixels(
    df: DataFrame,
    raster: str = "raster",
    keep: Sequence[str] = (),
    transform: Sequence[float | Column] = (1.0, 0.0, 0.0, 0.0, 1.0, 0.0),
    meta: dict[str, object] | None = None,
) -> DataFrame:
    """One row per pixel of ``band x row x col`` arrays, at the pixel centre.

    ``transform`` is the affine ``(a, b, c, d, e, f)`` of an unrotated grid; entries may be columns.
    """
    a, _, c, _, e, f = transform
    kept = [named(k) for k in keep]
    carried = [v for v in (a, c, e, f) if isinstance(v, Column)]
    if carried:
        df = df.withColumns({"_a": _lit(a), "_c": _lit(c), "_e": _lit(e), "_f": _lit(f)})
        kept += [F.col(n) for n in ("_a", "_c", "_e", "_f")]
        a, c, e, f = (F.col(n) for n in ("_a", "_c", "_e", "_f"))
    bands = df.select(*kept, F.posexplode(named(raster)).alias("band", "rows"))
    lines = bands.select(*kept, "band", F.posexplode("rows").alias("row", "cells"))
    cells = lines.select(*kept, "band", "row", F.posexplode("cells").alias("col", "cell"))
    pixels = cells.select(
        *[named(k) for k in keep],
        (F.col("band") + 1).alias("band"),
        "row",
        "col",
        pixel_centre(F.col("col"), c, a).alias("x"),
        pixel_centre(F.col("row"), f, e).alias("y"),
        F.col("cell").cast("double").alias("value"),
    )
    return attach_constants(pixels, meta) if meta else pixels


def _lit(value: float | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


# Names (quoted or before a colon) and the type words of a variant schema.
VARIANT_TOKEN = r"`(?:[^`]|``)*`|\w+(?=:)|OBJECT(?=<)|\bVOID\b|\bVARIANT\b|DECIMAL\((\d+),(\d+)\)"
TYPE_WORDS = {"OBJECT": "STRUCT", "VOID": "STRING", "VARIANT": "STRING"}
# A whole number of so many digits always fits a bigint.
BIGINT_DIGITS = 18


def variant_ddl(variant_schema: str) -> str:
    """A variant schema as a type the JSON reader takes.

    Numbers with a fraction are doubles, whole ones bigint or, where they are
    longer, decimals. Names stay as they are, also those that read like a type.
    """

    def translated(token: re.Match) -> str:
        text, (digits, scale) = token[0], token.groups()
        if digits is not None:
            return "DOUBLE" if scale != "0" else "BIGINT" if int(digits) <= BIGINT_DIGITS else text
        is_name = token.string[token.end() :].startswith(":")
        return f"`{text}`" if is_name and not text.startswith("`") else TYPE_WORDS.get(text, text)

    return re.sub(VARIANT_TOKEN, translated, variant_schema)


def json_objects_to_columns(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """One column per key found in a column of JSON objects.

    The keys and types are settled by one aggregate over the whole column. A key
    that is a kept column's name, or another key but for its case, gets a number.
    """
    return objects_as(df, text, object_schemas(df, text).first()["found"], keep)


def object_schemas(df: DataFrame, text: str, by: Sequence[str] = ()) -> DataFrame:
    """What keys and types a column of JSON objects holds, for each value of the ``by`` columns."""
    return df.groupBy(*[named(b) for b in by]).agg(F.schema_of_variant_agg(F.try_parse_json(named(text))).alias("found"))


def objects_as(df: DataFrame, text: str, found: str | None, keep: Sequence[str] = (), apart: Sequence[str] = ()) -> DataFrame:
    """The columns of JSON objects of a schema that ``object_schemas`` found, after the kept ones.

    Kept columns named in ``apart`` are no columns of the table: keys of their name stay as they are.
    """
    kept = [named(k) for k in keep]
    if found is None or not found.startswith("OBJECT<") or found == "OBJECT<>":
        return df.select(*kept)
    schema = T.StructType.fromDDL(variant_ddl(found).removeprefix("STRUCT<").removesuffix(">"))
    counted = [k for k in keep if k not in apart]
    names = unique_names([*counted, *schema.names])[len(counted) :]
    # A struct is cast field by field, in order: that renames them.
    renamed = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, schema)])
    return df.select(*kept, F.from_json(named(text), schema).cast(renamed).alias("_fields")).select(*kept, "_fields.*")


def geojson_features(df: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """One row per feature: properties and geometry as JSON text, plus what the geometry is."""
    features = df.select(
        *[named(k) for k in keep], F.inline(F.from_json(named(text), FEATURES_SCHEMA)["features"])
    )
    return describe_geometry(features)


def describe_geometry(features: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Geometry type, and longitude and latitude of points."""
    kind = F.get_json_object(named(geometry), "$.type")
    is_point = kind == "Point"
    point = lambda i: F.when(
        is_point, F.get_json_object(named(geometry), f"$.coordinates[{i}]").try_cast("double")
    )
    return features.withColumns({"geometry_type": kind, "lon": point(0), "lat": point(1)})


def expand_features(features: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Properties of features as columns of their own, next to the geometry."""
    return json_objects_to_columns(
        features, "properties", [*keep, "geometry", "geometry_type", "lon", "lat"]
    )


KML_SCHEMA = (
    "name string, description string, "
    "Point struct<coordinates string>, LineString struct<coordinates string>, "
    "Polygon struct<outerBoundaryIs struct<LinearRing struct<coordinates string>>, "
    "innerBoundaryIs array<struct<LinearRing struct<coordinates string>>>>"
)


def placemark_rows(placemarks: DataFrame, keep: Sequence[str] = (), text: str = "text") -> DataFrame:
    """KML placemarks as name, description and a GeoJSON geometry.

    Points, lines and polygons are column expressions. Only the XML of other placemarks, given
    in ``text``, is walked: collections keep their nesting and order, and a geometry that has no
    GeoJSON form, such as a track, fails.
    """
    point = coordinates(F.col("Point.coordinates"))
    line = coordinates(F.col("LineString.coordinates"))
    ring = coordinates(F.col("Polygon.outerBoundaryIs.LinearRing.coordinates"))
    holes = F.transform(
        F.coalesce(F.col("Polygon.innerBoundaryIs"), F.expr("cast(array() as " + _holes_type() + ")")),
        lambda h: coordinates(h["LinearRing"]["coordinates"]),
    )
    as_json = lambda kind, value: F.to_json(F.struct(F.lit(kind).alias("type"), value.alias("coordinates")))
    geometry = (
        F.when(F.col("Point").isNotNull(), as_json("Point", F.get(point, F.lit(0))))
        .when(F.col("LineString").isNotNull(), as_json("LineString", line))
        .when(F.col("Polygon").isNotNull(), as_json("Polygon", F.concat(F.array(ring), holes)))
    )
    is_plain = F.col("Point").isNotNull() | F.col("LineString").isNotNull() | F.col("Polygon").isNotNull()
    geometry = F.coalesce(geometry, placemark_geometry(F.when(~is_plain, named(text))))
    rows = placemarks.select(*[named(k) for k in keep], "name", "description", geometry.alias("geometry"))
    return describe_geometry(rows)


def _holes_type() -> str:
    return "array<struct<LinearRing struct<coordinates string>>>"


def widen_attributes(df: DataFrame, attributes: str, keep: Sequence[str] = ()) -> DataFrame:
    """One text column per key found in a map column; a row without the key holds null."""
    keys = df.select(F.explode(F.map_keys(named(attributes))).alias("k")).distinct().orderBy("k").collect()
    # try_element_at reads a missing key as null; the names are bounded by what a schema can hold.
    return df.select(
        *[named(k) for k in keep],
        *[F.try_element_at(named(attributes), F.lit(r["k"])).cast("string").alias(r["k"]) for r in keys],
    )


def union_ragged(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of frames with differing columns; what a frame lacks is null."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
