"""Catalog tables: schemas, loads, and one table per value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from terralode.functions.names import safe_identifier
from terralode.operators.clean import stringify_objects
from terralode.session import local_rows


# Labels of the folders that hold rows without a value and rows with the empty one.
NULL_LABEL = "__null__"
EMPTY_LABEL = "__empty__"


def quoted(schema: str, table: str) -> str:
    return f"`{schema}`.`{table}`"


def schema_for(custom: str | None, default: str) -> str:
    """The schema a model goes to: its own when it names one, else the default."""
    return default if custom is None else custom.strip()


def create_schema(spark: SparkSession, schema: str, location: str | None = None) -> str:
    """Create a schema; ``location`` puts its tables in a folder all executors share."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`{where}")
    return schema


def save_table(df: DataFrame, schema: str, name: str) -> str:
    """Create or replace a table; a name the catalog would refuse is made safe and kept as a property."""
    safe = safe_identifier(name)
    stringify_objects(df).write.mode("overwrite").format("parquet").saveAsTable(quoted(schema, safe))
    remember_name(df.sparkSession, schema, safe, name)
    return safe


def declare_table(rows: DataFrame, place: str, schema: str, name: str) -> str:
    """Create or replace a table over Parquet files where they lie, given as read from there."""
    spark, safe = rows.sparkSession, safe_identifier(name)
    spark.sql(f"DROP TABLE IF EXISTS {quoted(schema, safe)}")
    spark.catalog.createTable(f"{schema}.{safe}", path=place, source="parquet", schema=rows.schema)
    remember_name(spark, schema, safe, name)
    return safe


def remember_name(spark: SparkSession, schema: str, safe: str, name: str) -> None:
    if safe != name:
        escaped = name.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {quoted(schema, safe)} SET TBLPROPERTIES ('original_name' = '{escaped}')")


def append_by_name(df: DataFrame, schema: str, name: str) -> str:
    """Add rows to a table, columns matched by exact name; those the table lacks are left out."""
    table = df.sparkSession.table(quoted(schema, name))
    present = set(df.columns)
    columns = [
        (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema
    ]
    df.select(columns).write.insertInto(quoted(schema, name))
    return name


def split_to_tables(df: DataFrame, by: str, schema: str, path: str, prefix: str = "") -> dict[str, str]:
    """One table per value of a column, all out of one write.

    The data is written once, foldered by the value; each table is then declared
    over its folder. The rebalance splits a value that holds much of the data.
    """
    spark = df.sparkSession
    value = F.col(f"`{by}`").cast("string")
    label = F.when(value.isNull(), NULL_LABEL).when(value == "", EMPTY_LABEL).otherwise(value)
    marked = df.withColumn("_part", label).drop(by)
    marked.hint("rebalance", "_part").write.mode("overwrite").partitionBy("_part").parquet(path)
    # The given schema keeps a value such as 007 a text; only Parquet footers are read.
    labels = spark.read.schema(marked.schema).parquet(path).select("_part").distinct().orderBy("_part")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.schema if f.name != "_part")
    tables: dict[str, str] = {}
    for row in labels.collect():
        name = safe_identifier(prefix + row["_part"])
        if name.lower() in {t.lower() for t in tables.values()}:
            raise ValueError(f"two values of {by} give the table name {name}")
        folder = f"{path}/_part={_escaped(row['_part'])}"
        spark.sql(f"DROP TABLE IF EXISTS {quoted(schema, name)}")
        spark.sql(f"CREATE TABLE {quoted(schema, name)} ({columns}) USING parquet LOCATION '{folder}'")
        tables[row["_part"]] = name
    return tables


def _escaped(value: str) -> str:
    """A partition value the way a folder name spells it."""
    reserved = set("\"#%'*/:=?\\\x7f{[]^")
    return "".join(f"%{ord(c):02X}" if c in reserved or ord(c) < 32 else c for c in value)


def manifest(spark: SparkSession, tables: Sequence[str], source: str = "raw") -> DataFrame:
    """The source manifest: one row per table."""
    return local_rows(spark, [(source, t) for t in tables], "source string, table string")


def save_manifest(sources: DataFrame, path: str) -> str:
    sources.write.mode("overwrite").json(path)
    return path


def load_manifest(spark: SparkSession, path: str, source: str = "raw") -> DataFrame:
    """Tables of one source."""
    return spark.read.schema("source string, table string").json(path).filter(F.col("source") == source)
