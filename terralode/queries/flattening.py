"""Documents, rasters, features and ragged records to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terralode.functions.nested import coordinates
from terralode.operators import flatten
from terralode.queries.registry import query, table

# What separates words, as in the library's word pattern.
WORD_SQL = (
    "[^\\s\\x{0B}\\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+"
)


def words_sql(text: str) -> str:
    return f"cast(len(regexp_extract_all({text}, '{WORD_SQL}')) as integer)"


PARAGRAPHS_SQL = f"""
with p as (
  select doc_id, unnest(string_split(text, chr(10))) as text,
         generate_subscripts(string_split(text, chr(10)), 1) as n from documents
)
select doc_id, cast(n as integer) as paragraph_number, text, cast(length(text) as integer) as char_count,
       {words_sql('text')} as word_count
from p where {words_sql('text')} > 0
"""


@query("doc_paragraphs", PARAGRAPHS_SQL)
def doc_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.paragraphs(table(spark, sf_dir, "documents"), keep=["doc_id"])


STYLED_SQL = f"""
with p as (
  select doc_id, unnest(string_split(text, chr(10))) as text,
         generate_subscripts(string_split(text, chr(10)), 1) as n from documents
)
select doc_id, cast(n as integer) as paragraph_number, text, case when n = 1 then 'Title' else 'Normal' end as style,
       cast(length(text) as integer) as char_count, {words_sql('text')} as word_count
from p where {words_sql('text')} > 0
"""


@query("styled_paragraphs", STYLED_SQL)
def styled_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = F.transform(
        F.split("text", "\n"),
        lambda t, i: F.struct(t.alias("text"), F.when(i == 0, "Title").otherwise("Normal").alias("style")),
    )
    documents = table(spark, sf_dir, "documents").select("doc_id", items.alias("paragraphs"))
    return flatten.styled_paragraphs(documents, keep=["doc_id"])


@query(
    "doc_pages",
    f"""
with p as (
  select conv_id, turn, unnest(string_split(text, '. ')) as text,
         generate_subscripts(string_split(text, '. '), 1) as n from conversations
)
select conv_id, turn, cast(n as integer) as page_number, text, cast(length(text) as integer) as char_count,
       {words_sql('text')} as word_count
from p
""",
)
def doc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.pages(table(spark, sf_dir, "conversations"), keep=["conv_id", "turn"], sep=r"\. ")


def rasters(embeddings: DataFrame) -> DataFrame:
    """Vectors as rasters of two bands of 4 x 8 cells."""
    at = lambda band, row: F.slice("embedding", band * 32 + row * 8 + 1, 8)
    bands = [F.array(*[at(band, row) for row in range(4)]) for band in range(2)]
    return embeddings.select("vec_id", F.array(*bands).alias("raster"))


PIXELS_SQL = """
  select vec_id, cast(i // 32 + 1 as integer) as band, cast(i // 8 % 4 as integer) as "row", cast(i % 8 as integer) as col,
         10.0::double + (i % 8 + 0.5::double) * 0.25::double as x, 50.0::double + (i // 8 % 4 + 0.5::double) * -0.5::double as y,
         cast(v as double) as value
  from (select vec_id, unnest(embedding) as v, generate_subscripts(embedding, 1) - 1 as i from embeddings)
"""


@query("raster_flatten", f"select *, 'EPSG:4326' as meta_crs, '8' as meta_width from ({PIXELS_SQL})")
def raster_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.raster_pixels(
        rasters(table(spark, sf_dir, "embeddings")),
        keep=["vec_id"],
        transform=(0.25, 0, 10, 0, -0.5, 50),
        meta={"crs": "EPSG:4326", "width": 8},
    )


@query(
    "pixel_mean_by_band",
    f"select vec_id, band, round(avg(value), 6) as mean_value, count(*) as pixels from ({PIXELS_SQL}) group by vec_id, band",
)
def pixel_mean_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = flatten.raster_pixels(rasters(table(spark, sf_dir, "embeddings")), keep=["vec_id"])
    return pixels.groupBy("vec_id", "band").agg(
        F.round(F.avg("value"), 6).alias("mean_value"), F.count(F.lit(1)).alias("pixels")
    )


@query(
    "geojson_features",
    """
select c_custkey as id, c_name as name, c_mktsegment as segment, 'Point' as geometry_type,
       c_nationkey * 0.5::double as lon, c_nationkey - 12.25::double as lat
from customer
""",
)
def geojson_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).alias("properties"),
        F.struct(
            F.lit("Point").alias("type"),
            F.array(F.col("c_nationkey") * F.lit(0.5), F.col("c_nationkey") - F.lit(12.25)).alias("coordinates"),
        ).alias("geometry"),
    )
    collection = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features")))
    features = flatten.geojson_features(table(spark, sf_dir, "customer").select(collection.alias("text")))
    return flatten.expand_features(features).drop("geometry")


@query(
    "widen_attributes",
    """
select event_id, case when event_type <> 'error' then props->>'k' end as k,
       case when event_type = 'click' then cast(user_id as varchar) end as radius
from (select event_id, event_type, user_id, cast(props as json) as props from events)
""",
)
def widen_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.expr("cast(map() as map<string, string>)")
    props = F.when(F.col("event_type") != "error", F.from_json("props", "map<string, string>")).otherwise(none)
    radius = F.when(F.col("event_type") == "click", F.create_map(F.lit("radius"), F.col("user_id").cast("string"))).otherwise(none)
    entities = table(spark, sf_dir, "events").select("event_id", F.map_concat(props, radius).alias("attributes"))
    return flatten.widen_attributes(entities, "attributes", keep=["event_id"])


@query(
    "ragged_union",
    """
select c_name as name, c_mktsegment as segment, cast(null as double) as balance from customer
union all select s_name, null, s_acctbal from supplier
""",
)
def ragged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return flatten.union_ragged([customers, suppliers])


@query(
    "coordinate_texts",
    """
with c as (select s_suppkey, s_nationkey * 0.5::double as lon, s_nationkey - 12.25::double as lat from supplier)
select s_suppkey, 3 as points, lon as first_lon, lat as first_lat, lat as last_alt from c
""",
)
def coordinate_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lon, lat = F.col("s_nationkey") * F.lit(0.5), F.col("s_nationkey") - F.lit(12.25)
    text = F.concat_ws(" ", F.concat_ws(",", lon, lat), F.concat_ws(",", lat, lon), F.concat_ws(",", lon, lon, lat))
    points = coordinates(F.concat(F.lit("\n  "), text, F.lit(" ")))
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.size(points).alias("points"),
        F.get(F.get(points, F.lit(0)), F.lit(0)).alias("first_lon"),
        F.get(F.get(points, F.lit(0)), F.lit(1)).alias("first_lat"),
        F.get(F.get(points, F.lit(2)), F.lit(2)).alias("last_alt"),
    )
