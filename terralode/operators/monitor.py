"""Volume, run-history and health queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from terralode.functions.measures import bytes_human, duration_seconds, labels
from terralode.functions.names import has_suffix, top_folder
from terralode.session import local_rows


def capped_listing(listing: DataFrame, max_keys: int = 5000) -> DataFrame:
    """The first ``max_keys`` objects by key, then newest first, sizes made readable.

    The cap comes before the sort by time: it is the first keys that count, not the newest.
    """
    first = listing.orderBy("key").limit(max_keys)
    return first.withColumn("size", bytes_human(F.col("size_bytes"))).orderBy(F.col("last_modified").desc())


def latest_with_suffix(listing: DataFrame, suffixes: Sequence[str] = (".parquet",), n: int = 200) -> DataFrame:
    """The newest objects of a kind, as shown in a panel."""
    kind = listing.filter(has_suffix(F.col("key"), list(suffixes)))
    newest = kind.orderBy(F.col("last_modified").desc_nulls_last(), "key").limit(n)
    return newest.select("key", bytes_human(F.col("size_bytes")).alias("size"), "last_modified")


def volume_kpis(listing: DataFrame) -> DataFrame:
    """Number of objects, their total size and the latest change."""
    return listing.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("size_bytes"), F.lit(0).cast("bigint")).alias("total_bytes"),
        F.max("last_modified").alias("last_modified"),
    ).withColumn("total_size", bytes_human(F.col("total_bytes")))


def top_folder_breakdown(listing: DataFrame, prefix: str = "") -> DataFrame:
    """Objects per first folder under the prefix, largest first."""
    return (
        listing.groupBy(top_folder(F.col("key"), prefix).alias("group"))
        .agg(F.count(F.lit(1)).alias("files"))
        .orderBy(F.col("files").desc(), "group")
    )


def with_duration(runs: DataFrame) -> DataFrame:
    return runs.withColumn("duration_s", duration_seconds(F.col("start_date"), F.col("end_date")))


def recent_runs(
    runs: DataFrame,
    dag_id: str | None = None,
    limit: int = 50,
    only: Sequence[str] = (),
    tie_break: Sequence[Column | str] = ("run_id",),
) -> DataFrame:
    """The latest runs, of one workflow or of all, newest first and undated ones last.

    ``only`` narrows the result after the cap, as a picker over a shown list does.
    """
    if dag_id:
        runs = runs.filter(F.col("dag_id") == dag_id)
    latest = runs.orderBy(F.col("start_date").desc_nulls_last(), *tie_break).limit(limit)
    if only:
        latest = latest.filter(F.col("dag_id").isin(list(only)))
    return with_duration(latest)


def task_durations(tasks: DataFrame, dag_id: str, run_id: str) -> DataFrame:
    """Tasks of one run in order of their start, those not started last."""
    one_run = (F.col("dag_id") == dag_id) & (F.col("run_id") == run_id)
    kept = with_duration(tasks.filter(one_run))
    return kept.select("task_id", "state", "start_date", "end_date", "duration_s").orderBy(
        F.col("start_date").asc_nulls_last()
    )


def run_durations(runs: DataFrame, dag_id: str, limit: int = 50, tie_break: Sequence[Column | str] = ("run_id",)) -> DataFrame:
    """Latest runs of one workflow and how long each took."""
    latest = runs.filter(F.col("dag_id") == dag_id).orderBy(F.col("start_date").desc_nulls_last(), *tie_break)
    kept = with_duration(latest.limit(limit))
    return kept.select("run_id", "state", "start_date", "end_date", "duration_s")


def last_state(runs: DataFrame, missing: str = "—") -> DataFrame:
    """State and run id of the latest run per workflow.

    A maximum, so each task sends one row per workflow whatever its share of the runs.
    """
    latest = F.max_by(F.struct("state", "run_id"), F.struct("start_date", "run_id"))
    return (
        runs.groupBy("dag_id")
        .agg(latest.alias("last"))
        .select(
            "dag_id",
            F.coalesce("last.state", F.lit(missing)).alias("state"),
            F.coalesce("last.run_id", F.lit(missing)).alias("run_id"),
        )
    )


def last_state_of(runs: DataFrame, dag_ids: Sequence[str], missing: str = "—") -> DataFrame:
    """Latest state of each asked workflow, also of one that never ran."""
    asked = local_rows(runs.sparkSession, [(d,) for d in dag_ids], "dag_id string")
    found = last_state(runs.filter(F.col("dag_id").isin(list(dag_ids))), missing)
    return asked.join(found, "dag_id", "left").select(
        "dag_id", F.coalesce("state", F.lit(missing)).alias("state"), F.coalesce("run_id", F.lit(missing)).alias("run_id")
    )


def state_counts(runs: DataFrame, success: str = "success", failed: str = "failed", running: str = "running") -> DataFrame:
    """How many runs succeeded, failed or still run; zeros when there are none."""
    return runs.agg(
        F.count_if(F.col("state") == success).alias("success"),
        F.count_if(F.col("state") == failed).alias("failed"),
        F.count_if(F.col("state") == running).alias("running"),
    )


def total_and_slowest(tasks: DataFrame) -> DataFrame:
    """Summed seconds, and the task that took longest, in one pass."""
    return tasks.agg(
        F.sum("duration_s").alias("total_s"),
        F.max("duration_s").alias("slowest_s"),
        F.max_by("task_id", F.when(F.col("duration_s").isNotNull(), F.struct("duration_s", "task_id"))).alias("slowest_task"),
    )


def slowest_first(tasks: DataFrame) -> DataFrame:
    return tasks.select("task_id", "state", "duration_s").orderBy(F.col("duration_s").desc_nulls_last())


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def count_with_suffix(listing: DataFrame, suffixes: Sequence[str]) -> DataFrame:
    return listing.agg(F.count_if(has_suffix(F.col("key"), list(suffixes))).alias("files"))


def model_counts(models: DataFrame, layer: str = "layer") -> DataFrame:
    """Models per layer."""
    return models.groupBy(layer).agg(F.count(F.lit(1)).alias("models"))


def artifact_kpis(models: DataFrame, manifest: DataFrame | None, layer: str = "layer") -> DataFrame:
    """Whether there is a manifest, and how many bronze and silver models."""
    return models.agg(
        F.lit(manifest is not None).alias("has_manifest"),
        F.count_if(F.col(layer) == "bronze").alias("bronze_models"),
        F.count_if(F.col(layer) == "silver").alias("silver_models"),
    )


def health(states: DataFrame, parquet_files: DataFrame, roles: dict[str, str]) -> DataFrame:
    """Alerts over the latest states; ``roles`` names the workflow of each step.

    Steps: ``ingestion``, ``conversion``, ``load`` and ``models``. Two one-row
    aggregates, the second read as a scalar.
    """
    state_of = {step: F.max(F.when(F.col("dag_id") == dag, F.col("state"))).alias(step) for step, dag in roles.items()}
    files = parquet_files.scalar()
    return states.agg(*state_of.values()).select(
        labels(
            ((F.col("ingestion") == "success") & (files == 0), "ingested_but_no_parquet"),
            (F.col("conversion") == "failed", "conversion_failed"),
            (F.col("load") == "failed", "load_failed"),
            (F.col("models") == "failed", "model_generation_failed"),
            default="ok",
        ).alias("alerts")
    )


def ingestion_totals(selected: DataFrame) -> DataFrame:
    """Datasets selected and files they bring, from ``(slug, resources)`` rows."""
    return selected.agg(
        F.count(F.lit(1)).alias("datasets"), F.coalesce(F.sum("resources"), F.lit(0).cast("bigint")).alias("files")
    )


def processed_totals(processed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files processed now and files processed ever."""
    now = processed.agg(F.count(F.lit(1)).alias("new_files"))
    ever = ledger.agg(F.count(F.lit(1)).alias("all_files"))
    return now.select("new_files", ever.scalar().alias("all_files"))


def column_catalog(columns: DataFrame) -> DataFrame:
    """Column descriptions of each table gathered into one template.

    Rows are columns of a schema, so a group is as small as a schema.
    """
    return columns.groupBy("table_name").agg(
        F.sort_array(F.collect_list(F.struct("position", "column_name", "data_type"))).alias("template")
    )
