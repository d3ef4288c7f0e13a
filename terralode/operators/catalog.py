"""Filing of files: lookup, routing, ledger, resources, sidecars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from terralode.formats import DOCUMENT_EXTENSIONS, FORMATS, ROUTES, UNKNOWN, formats_table
from terralode.functions.names import (
    file_extension,
    is_folder_key,
    resource_path,
    strip_prefix,
    url_extension,
)

# Files a shapefile cannot do without, and those it can.
SHAPEFILE_REQUIRED = ["shp", "shx", "dbf"]
SHAPEFILE_OPTIONAL = ["prj", "cpg"]


def supported_extensions(formats: DataFrame) -> DataFrame:
    """Distinct extensions of a format table."""
    return formats.select("ext").distinct()


def drop_folder_keys(listing: DataFrame, key: str = "key") -> DataFrame:
    return listing.filter(~is_folder_key(F.col(key)))


def under_category(listing: DataFrame, prefix: str = "", key: str = "key") -> DataFrame:
    """Keys filed under one of the known category folders, with the folder they lie in."""
    folder = F.substring_index(strip_prefix(F.col(key), prefix), "/", 1)
    categories = sorted({row[0] for row in FORMATS})
    return listing.filter(F.col(key).startswith(prefix) & folder.isin(categories)).withColumn("source_folder", folder)


def describe_files(files: DataFrame, key: str = "key", unknown: str = UNKNOWN[0]) -> DataFrame:
    """Extension, category, type and description of each file.

    The dictionary is a literal table of a few dozen rows, hence the broadcast.
    """
    formats = formats_table(files.sparkSession).withColumnRenamed("ext", "extension")
    return (
        files.withColumn("extension", file_extension(F.col(key)))
        .join(F.broadcast(formats), "extension", "left")
        .withColumn("category", F.coalesce("category", F.lit(unknown)))
        .withColumn("type", F.coalesce("type", F.lit(UNKNOWN[1])))
        .withColumn("description", F.coalesce("description", F.lit(UNKNOWN[2])))
    )


def new_files(listing: DataFrame, ledger: DataFrame, key: str = "key") -> DataFrame:
    """Files not yet in the ledger.

    Both sides grow with the data, so Spark picks the join by their size. A key the
    ledger holds many times counts once before it is shuffled.
    """
    return drop_folder_keys(listing, key).join(ledger.select(key).distinct(), key, "left_anti")


def scan_new_files(listing: DataFrame, ledger: DataFrame, prefix: str = "", key: str = "key") -> DataFrame:
    """Descriptors of the unprocessed files under the category folders."""
    return describe_files(new_files(under_category(listing, prefix, key), ledger, key), key)


def bucket_of(category: Column, extension: Column) -> Column:
    """The bucket a described file goes to; null for an unknown category."""
    documents = extension.isin(list(DOCUMENT_EXTENSIONS))
    return F.when(documents, F.lit("documents")).when(category.isin(ROUTES), category)


def route_files(files: DataFrame) -> DataFrame:
    """Described files with their bucket; unknown ones keep a null bucket so they can be reported."""
    return files.withColumn("bucket", bucket_of(F.col("category"), F.col("extension")))


def routed(files: DataFrame) -> dict[str, DataFrame]:
    """One filtered frame per bucket."""
    with_bucket = route_files(files)
    return {name: with_bucket.filter(F.col("bucket") == name) for name in ROUTES}


def route_counts(files: DataFrame, bucket: str = "bucket") -> DataFrame:
    """Files per bucket; empty buckets do not appear."""
    return files.filter(F.col(bucket).isNotNull()).groupBy(bucket).agg(F.count(F.lit(1)).alias("files"))


def supported_only(files: DataFrame, supported: DataFrame, on: str) -> DataFrame:
    """Files whose ``on`` value is among the supported ones."""
    return files.join(supported.select(on).distinct(), on, "left_semi")


def ledger_update(ledger: DataFrame, processed: DataFrame, key: str = "key") -> DataFrame:
    """All keys ever processed, each once."""
    return ledger.select(key).union(processed.select(key)).distinct()


def ledger_additions(ledger: DataFrame, processed: DataFrame, key: str = "key") -> DataFrame:
    """Processed keys the ledger lacks: what to append, without rewriting the ledger."""
    return processed.select(key).distinct().join(ledger.select(key).distinct(), key, "left_anti")


def concat_results(results: Sequence[DataFrame]) -> DataFrame:
    """All rows of several result frames, matched by column name."""
    first, *rest = results
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def dataset_resources(datasets: DataFrame) -> DataFrame:
    """One row per resource of datasets with a ``resources`` array of structs."""
    others = [c for c in datasets.columns if c != "resources"]
    return datasets.select(*others, F.inline("resources"))


def match_resources(resources: DataFrame, format_col: str = "format", url_col: str = "url") -> DataFrame:
    """Resources whose declared format or URL suffix is supported, with category and path.

    A resource yields one row per distinct supported match, so at most two. Each is
    exploded into its candidate extensions and looked up by equality, which keeps
    the either-or condition out of the join.
    """
    formats = formats_table(resources.sparkSession).select("category", "ext")
    declared = F.lower(F.coalesce(F.col(format_col), F.lit("")))
    candidates = F.array_distinct(F.array(declared, url_extension(F.coalesce(F.col(url_col), F.lit("")))))
    return (
        resources.withColumn("ext", F.explode(candidates))
        .join(F.broadcast(formats), "ext")
        .withColumn("path", resource_path(F.col("category"), F.col("ext")))
    )


def select_datasets(resources: DataFrame, slug: str = "slug") -> DataFrame:
    """Datasets with at least one supported resource, and how many matches each has."""
    return match_resources(resources).groupBy(slug).agg(F.count(F.lit(1)).alias("resources"))


def last_updated(datasets: DataFrame, n: int = 10, updated: str = "last_update", slug: str = "slug") -> DataFrame:
    """Slugs of the most recently updated datasets; a dataset without slug takes a place, then drops out."""
    newest = datasets.orderBy(F.col(updated).desc_nulls_last(), F.col(slug)).limit(n)
    return newest.filter(F.col(slug).isNotNull()).select(slug)


def sidecar_groups(files: DataFrame, base: str = "base", ext: str = "ext") -> DataFrame:
    """One row per shapefile: which parts it has and whether the required ones are all there.

    Parts are counted, never collected, so a base shared by very many files costs one
    partial row per task.
    """
    parts = SHAPEFILE_REQUIRED + SHAPEFILE_OPTIONAL
    relevant = files.filter(F.col(ext).isin(parts))
    grouped = relevant.groupBy(base).agg(
        *[F.coalesce(F.bool_or(F.col(ext) == part), F.lit(False)).alias(f"has_{part}") for part in parts]
    )
    complete = F.lit(True)
    for part in SHAPEFILE_REQUIRED:
        complete = complete & F.col(f"has_{part}")
    return grouped.withColumn("complete", complete)


def classify_fetches(results: DataFrame, status: str = "status", error: str = "error") -> DataFrame:
    """Outcome of each download: ``ok``, ``skipped`` for a 404, else ``error``."""
    code = F.col(status)
    failed = (code >= 400) | F.col(error).isNotNull() | code.isNull()
    return results.withColumn(
        "outcome", F.when(code == 404, "skipped").when(failed, "error").otherwise("ok")
    )


def fetch_report(results: DataFrame) -> DataFrame:
    """Downloads per outcome; the failing URLs stay rows of ``classify_fetches``."""
    return results.groupBy("outcome").agg(F.count(F.lit(1)).alias("files"))
