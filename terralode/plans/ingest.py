"""Catalogued datasets to the list of resources worth fetching, and what came of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terralode.functions.measures import now_text
from terralode.operators.catalog import (
    classify_fetches,
    dataset_resources,
    last_updated,
    match_resources,
)
from terralode.operators.monitor import ingestion_totals
from terralode.operators.quality import require_not_all_failed, require_positive, require_rows


# Metadata of a dataset as the catalogue publishes it; other fields are not read.
DATASET_SCHEMA = (
    "slug string, title string, last_update timestamp_ntz, "
    "resources array<struct<format string, url string, title string>>"
)


def landed_datasets(spark: SparkSession, path: str, slugs: list[str] = (), lines: bool = False) -> DataFrame:
    """Dataset metadata landed as JSON, of all datasets or of the named ones."""
    datasets = spark.read.schema(DATASET_SCHEMA).option("multiLine", not lines).json(path)
    return datasets.filter(F.col("slug").isin(list(slugs))) if slugs else datasets


def newest_datasets(datasets: DataFrame, n: int = 3) -> DataFrame:
    """The most recently updated datasets with their metadata; stops when there are none."""
    slugs = require_rows(last_updated(datasets, n), "no dataset listed")
    return datasets.join(slugs, "slug", "left_semi")


def select_resources(datasets: DataFrame) -> DataFrame:
    """Supported resources of datasets: one row per match, stamped; stops when there are none."""
    matched = match_resources(dataset_resources(datasets)).withColumn("fetched_at", now_text())
    return require_rows(matched, "no resource of a supported format")


def check_selection(resources: DataFrame) -> DataFrame:
    """Totals of a selection; stops when it brings no file."""
    per_dataset = resources.groupBy("slug").agg(F.count(F.lit(1)).alias("resources"))
    totals = ingestion_totals(per_dataset)
    require_positive(totals, F.sum("files"), "selection without files")
    return totals


def check_fetches(results: DataFrame) -> DataFrame:
    """Outcomes of the downloads; stops only when there were errors and nothing arrived."""
    return require_not_all_failed(classify_fetches(results), "no file could be fetched")
