"""Source tables to bronze and silver models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from terralode.functions.names import safe_identifier
from terralode.operators.clean import auto_clean
from terralode.plans.runner import run_each
from terralode.sinks.tables import quoted, save_table

Transform = Callable[[DataFrame], DataFrame]


def table_names(sources: DataFrame, source: str) -> list[str]:
    rows = sources.filter(F.col("source") == source).select("table").distinct().orderBy("table").collect()
    return [row["table"] for row in rows]


def build_bronze(
    spark: SparkSession, sources: DataFrame, source_schema: str, bronze_schema: str = "bronze", source: str = "raw"
) -> DataFrame:
    """``bronze_<table>`` per table of the manifest: the table as it is.

    A view, so bronze copies no data and a filter on it reaches the table's files.
    """

    def build(table: str) -> list[str]:
        name = safe_identifier(f"bronze_{table}")
        spark.sql(
            f"CREATE OR REPLACE VIEW {quoted(bronze_schema, name)} AS SELECT * FROM {quoted(source_schema, table)}"
        )
        return [name]

    return run_each(spark, table_names(sources, source), build, workers=1)


def build_silver(
    spark: SparkSession,
    bronze_models: list[str],
    bronze_schema: str = "bronze",
    silver_schema: str = "silver",
    transform: Transform = auto_clean,
    workers: int = 4,
) -> DataFrame:
    """``silver_<table>`` per bronze model: what ``transform`` makes of it."""

    def build(model: str) -> list[str]:
        name = "silver_" + model.removeprefix("bronze_")
        return [save_table(transform(spark.table(quoted(bronze_schema, model))), silver_schema, name)]

    return run_each(spark, bronze_models, build, workers)


def build_models(
    spark: SparkSession,
    sources: DataFrame,
    source_schema: str,
    bronze_schema: str = "bronze",
    silver_schema: str = "silver",
    source: str = "raw",
    transform: Transform = auto_clean,
) -> DataFrame:
    """Bronze, then silver over what bronze made; one result row per model."""
    bronze = build_bronze(spark, sources, source_schema, bronze_schema, source)
    made = [row["table"] for row in bronze.filter("ok").select("table").collect()]
    silver = build_silver(spark, made, bronze_schema, silver_schema, transform)
    return bronze.withColumn("layer", F.lit("bronze")).unionByName(silver.withColumn("layer", F.lit("silver")))
