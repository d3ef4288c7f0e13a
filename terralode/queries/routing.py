"""Routing, ledger and naming queries. Documents stand for files, labels for the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terralode.formats import FORMATS, ROUTES, formats_table
from terralode.functions import names
from terralode.functions.measures import labels
from terralode.functions.nested import json_field, json_keys
from terralode.operators import catalog
from terralode.operators.monitor import processed_totals
from terralode.queries.monitoring import RESOURCES_SQL, resources_of
from terralode.queries.registry import query, table

FORMATS_SQL = "(values " + ", ".join(f"('{c}', '{e}', '{t}', '{d}')" for c, e, t, d in FORMATS) + ") as f(category, ext, type, description)"

# Suffix of a document's file by its language; other languages are written in full.
SUFFIXES = {"en": ".csv", "fr": ".GeoJSON", "de": ".docx"}


def files_of(documents: DataFrame) -> DataFrame:
    """Documents as files of a store."""
    suffix = F.when(F.col("source") == "src0", "").otherwise(F.concat(F.lit("."), F.col("lang")))
    for lang, text in SUFFIXES.items():
        suffix = F.when(F.col("lang") == lang, text).otherwise(suffix)
    return documents.select(F.concat("source", F.lit("/doc"), "doc_id", suffix).alias("key"), "doc_id", "lang", "source")


FILES_SQL = f"""
  select source || '/doc' || doc_id ||
         case {' '.join(f"when lang = '{k}' then '{v}'" for k, v in reversed(SUFFIXES.items()))}
              when source = 'src0' then '' else '.' || lang end as key, doc_id, lang, source
  from documents
"""

EXTENSION_SQL = "case when contains(key, '.') then lower(regexp_extract(key, '([^.]*)$', 1)) else '' end"

DESCRIBED_SQL = f"""
  select key, extension, coalesce(f.category, 'unknown') as category, coalesce(f.type, 'inconnu') as type,
         coalesce(f.description, 'Format non reconnu') as description
  from (select *, {EXTENSION_SQL} as extension from ({FILES_SQL})) left join {FORMATS_SQL} on f.ext = extension
"""

BUCKET_SQL = f"""
  case when extension in ('pdf', 'docx', 'odt') then 'documents'
       when category in ({', '.join(f"'{r}'" for r in ROUTES)}) then category end
"""


def ledger_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files already processed: those of labelled documents."""
    done = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return files_of(done).select("key")


LEDGER_SQL = f"select key from ({FILES_SQL}) where doc_id in (select doc_id from labels)"


@query("file_ext_lookup", DESCRIBED_SQL)
def file_ext_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = catalog.describe_files(files_of(table(spark, sf_dir, "documents")).select("key"))
    return described.select("key", "extension", "category", "type", "description")


@query("route_counts", f"select {BUCKET_SQL} as bucket, count(*) as files from ({DESCRIBED_SQL}) where {BUCKET_SQL} is not null group by 1")
def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = catalog.describe_files(files_of(table(spark, sf_dir, "documents")).select("key"))
    return catalog.route_counts(catalog.route_files(described))


@query("unknown_files", f"select key, extension from ({DESCRIBED_SQL}) where {BUCKET_SQL} is null")
def unknown_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = catalog.describe_files(files_of(table(spark, sf_dir, "documents")).select("key"))
    return catalog.route_files(described).filter(F.col("bucket").isNull()).select("key", "extension")


@query("new_files", f"select key, doc_id from ({FILES_SQL}) anti join ({LEDGER_SQL}) using (key)")
def new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = files_of(table(spark, sf_dir, "documents")).select("key", "doc_id")
    return catalog.new_files(listing, ledger_of(spark, sf_dir))


SCANNED_SQL = f"""
  select key, folder as source_folder, extension, coalesce(f.category, 'unknown') as category
  from (select 'raw/' || case when lang = 'en' then 'tabular' when lang = 'fr' then 'geospatial_vector' else 'misc' end || '/' || key as key,
               case when lang = 'en' then 'tabular' when lang = 'fr' then 'geospatial_vector' end as folder, {EXTENSION_SQL} as extension
        from ({FILES_SQL}) where doc_id not in (select doc_id from labels))
  left join {FORMATS_SQL} on f.ext = extension
  where folder is not null
"""


@query("scan_new_files", SCANNED_SQL)
def scan_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = F.when(F.col("lang") == "en", "tabular").when(F.col("lang") == "fr", "geospatial_vector").otherwise("misc")
    filed = lambda files: files.select(F.concat(F.lit("raw/"), folder, F.lit("/"), "key").alias("key"), "doc_id")
    files = filed(files_of(table(spark, sf_dir, "documents")))
    ledger = files.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    found = catalog.scan_new_files(files.select("key"), ledger, "raw/")
    return found.select("key", "source_folder", "extension", "category")


EN_FILES_SQL = f"select key from ({FILES_SQL}) where lang = 'en'"


@query("ledger_update", f"{LEDGER_SQL} union {EN_FILES_SQL}")
def ledger_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = files_of(table(spark, sf_dir, "documents").filter(F.col("lang") == "en"))
    return catalog.ledger_update(ledger_of(spark, sf_dir), processed)


@query("ledger_additions", f"select key from ({EN_FILES_SQL}) except select key from ({LEDGER_SQL})")
def ledger_additions(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = files_of(table(spark, sf_dir, "documents").filter(F.col("lang") == "en"))
    return catalog.ledger_additions(ledger_of(spark, sf_dir), processed)


@query(
    "processed_totals",
    f"select (select count(*) from ({EN_FILES_SQL})) as new_files, (select count(*) from ({LEDGER_SQL} union {EN_FILES_SQL})) as all_files",
)
def processed_totals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = files_of(table(spark, sf_dir, "documents").filter(F.col("lang") == "en"))
    return processed_totals(processed, catalog.ledger_update(ledger_of(spark, sf_dir), processed))


@query(
    "processed_concat",
    """
select source || '/' || doc_id as key, 'documents' as bucket from documents
union all select url, 'others' from pages union all select cast(vec_id as varchar), 'geospatial_raster' from embeddings
""",
)
def processed_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = [
        table(spark, sf_dir, "documents").select(F.concat_ws("/", "source", "doc_id").alias("key"), F.lit("documents").alias("bucket")),
        table(spark, sf_dir, "pages").select(F.lit("others").alias("bucket"), F.col("url").alias("key")),
        table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("key"), F.lit("geospatial_raster").alias("bucket")),
    ]
    return catalog.concat_results(results)


@query(
    "routed_files",
    f"select key, category from ({DESCRIBED_SQL}) where {BUCKET_SQL} = 'geospatial_vector'",
)
def routed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = catalog.describe_files(files_of(table(spark, sf_dir, "documents")).select("key"))
    return catalog.routed(described)["geospatial_vector"].select("key", "category")


@query("semi_supported", f"select key, extension from (select *, {EXTENSION_SQL} as extension from ({FILES_SQL})) semi join (select ext as extension from {FORMATS_SQL}) using (extension)")
def semi_supported(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = files_of(table(spark, sf_dir, "documents")).select("key")
    supported = catalog.supported_extensions(formats_table(spark)).withColumnRenamed("ext", "extension")
    with_ext = files.withColumn("extension", names.file_extension(F.col("key")))
    return catalog.supported_only(with_ext, supported, "extension").select("key", "extension")


MATCHED_SQL = f"""
  with e as (select *, lower(format) as fmt,
                    lower(regexp_extract(regexp_replace(url, '[?#].*$', ''), '\\.([^./]*)$', 1)) as url_ext from ({RESOURCES_SQL}))
  select e.slug, e.event_id, e.url, f.ext, f.category, f.category || '/' || f.ext || '/' as path
  from e join {FORMATS_SQL} on e.fmt = f.ext or e.url_ext = f.ext
"""


@query("resource_match", MATCHED_SQL)
def resource_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = catalog.match_resources(resources_of(table(spark, sf_dir, "events")))
    return matched.select("slug", "event_id", "url", "ext", "category", "path")


@query("dataset_resources", "select 'customer-' || o_custkey as slug, 'https://host/' || o_orderkey || '.csv' as url, o_orderpriority as format from orders")
def dataset_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datasets that hold an array of resources, one row per resource."""
    url = F.concat(F.lit("https://host/"), F.col("o_orderkey"), F.lit(".csv")).alias("url")
    held = table(spark, sf_dir, "orders").select(F.concat(F.lit("customer-"), F.col("o_custkey")).alias("slug"), F.struct(url, F.col("o_orderpriority").alias("format")).alias("r"))
    return catalog.dataset_resources(held.groupBy("slug").agg(F.collect_list("r").alias("resources")))


@query("select_datasets", f"select slug, count(*) as resources from ({MATCHED_SQL}) group by slug")
def select_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.select_datasets(resources_of(table(spark, sf_dir, "events")))


@query(
    "last_updated",
    """
select slug from (
  select case when o_orderstatus <> 'P' then 'dataset-' || o_orderkey end as slug, o_orderkey from orders
  order by o_orderdate desc nulls last, slug nulls first limit 100
) where slug is not null
""",
)
def last_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    datasets = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("dataset-"), F.col("o_orderkey"))).alias("slug"),
        F.col("o_orderdate").alias("last_update"),
    )
    return catalog.last_updated(datasets, 100)


@query(
    "sidecar_complete",
    """
with p as (
  select p_type || '/' || p_brand || '/' || p_name as base,
         case when p_size <= 10 then 'shp' when p_size <= 20 then 'shx' when p_size <= 30 then 'dbf'
              when p_size <= 40 then 'prj' else 'txt' end as ext
  from part
)
select base, bool_or(ext = 'shp') as has_shp, bool_or(ext = 'shx') as has_shx, bool_or(ext = 'dbf') as has_dbf,
       bool_or(ext = 'prj') as has_prj, bool_or(ext = 'cpg') as has_cpg,
       count(distinct ext) filter (where ext in ('shp', 'shx', 'dbf')) = 3 as complete
from p where ext in ('shp', 'shx', 'dbf', 'prj', 'cpg') group by base
""",
)
def sidecar_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    ext = F.when(size <= 10, "shp").when(size <= 20, "shx").when(size <= 30, "dbf").when(size <= 40, "prj").otherwise("txt")
    files = table(spark, sf_dir, "part").select(
        F.concat_ws("/", "p_type", "p_brand", "p_name").alias("base"), ext.alias("ext")
    )
    return catalog.sidecar_groups(files)


@query(
    "names_from_key",
    r"""
with u as (select page_id, url, regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '(;[^/?#]*)?([?#].*)?$', '') as path from pages),
     b as (select *, regexp_extract(path, '([^/]*)$', 1) as base, regexp_extract(regexp_replace(path, '/+$', ''), '([^/]*)$', 1) as last from u)
select page_id,
       lower(regexp_extract(base, '^\.*[^.].*\.([^.]*)$', 1)) as url_ext,
       coalesce(nullif(last, ''), 'downloaded_file') as file_name,
       regexp_replace(last, '^(\.*[^.].*)\.[^.]*$', '\1') as table_name,
       'parquets_files/' || regexp_replace(last, '^(\.*[^.].*)\.[^.]*$', '\1') || '.parquet' as parquet_key,
       regexp_replace(url, '[^\w\-]', '_', 'g') as run_id,
       case when ends_with(last, '.html') then substr(last, 1, length(last) - 5) else last || '.decompressed' end as inner_name,
       split_part(regexp_replace(url, '^https?://', ''), '/', 1) as host
from b
""",
)
def names_from_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    last = names.basename(F.regexp_replace(names.url_path(url), "/+$", ""))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        names.url_extension(url).alias("url_ext"),
        names.url_basename(url).alias("file_name"),
        names.table_name(last).alias("table_name"),
        names.parquet_key(last).alias("parquet_key"),
        names.sanitize_run_id(url).alias("run_id"),
        names.strip_suffix(last, ".html").alias("inner_name"),
        names.top_folder(F.regexp_replace(url, "^https?://", "")).alias("host"),
    )


@query(
    "json_with_default",
    """
with e as (
  select event_id, case when event_type = 'error' then substr(props, 1, 4) when event_type = 'view' then '{}' else props end as props,
         case when event_type = 'click' then 'not json' else '["' || event_type || '","' || user_id || '"]' end as keys
  from events
)
select event_id, coalesce(try_cast(props as json)->>'k', 'none') as k,
       cast(coalesce(json_array_length(try_cast(keys as json)), 0) as integer) as n_keys
from e
""",
)
def json_with_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    props = F.when(kind == "error", F.substring("props", 1, 4)).when(kind == "view", "{}").otherwise(F.col("props"))
    keys = F.when(kind == "click", "not json").otherwise(F.concat(F.lit('["'), kind, F.lit('","'), "user_id", F.lit('"]')))
    return table(spark, sf_dir, "events").select(
        "event_id", json_field(props, "k", "none").alias("k"), F.size(json_keys(keys)).alias("n_keys")
    )


@query(
    "quality_gate",
    """
with s as (
  select user_id, count(*) as events, count(*) filter (where event_type = 'error') as errors,
         bool_and(event_type = 'error') as only_errors
  from events group by user_id
),
a as (
  select user_id, events, errors,
         list_filter([case when only_errors then 'nothing_arrived' end,
                      case when errors * 4 > events then 'many_errors' end,
                      case when errors = 0 then 'no_error' end], lambda x: x is not null) as found from s
)
select user_id, events, errors, case when len(found) = 0 then 'ok' else array_to_string(found, ',') end as verdict from a
""",
)
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_error = F.col("event_type") == "error"
    per_user = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if(is_error).alias("errors"),
            F.bool_and(is_error).alias("only_errors"),
        )
    )
    verdict = labels(
        (F.col("only_errors"), "nothing_arrived"),
        (F.col("errors") * 4 > F.col("events"), "many_errors"),
        (F.col("errors") == 0, "no_error"),
        default="ok",
    )
    return per_user.select("user_id", "events", "errors", F.array_join(verdict, ",").alias("verdict"))


@query("without_folder_keys", "select event_type || '/' || event_id as key from events where event_id % 10 <> 0")
def without_folder_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of a listing less the markers of its folders, which end with a slash."""
    key = F.concat("event_type", F.lit("/"), "event_id", F.when(F.col("event_id") % 10 == 0, "/").otherwise(""))
    return catalog.drop_folder_keys(table(spark, sf_dir, "events").select(key.alias("key")))
