"""Parquet files and partitioned folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terralode.operators.clean import stringify_objects


def write_table(df: DataFrame, path: str, legacy_null_tokens: bool = False, partition_by: str | None = None) -> str:
    """Write a table, nested values as text, replacing what was there; no rows still gives a table."""
    writer = stringify_objects(df, legacy_null_tokens).write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return path


def move_folder(spark: SparkSession, source: str, target: str) -> bool:
    """Move a written folder to its place, replacing what was there; false where there is no such folder.

    A step of the file system, no job; both are on the one that ``target`` names.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path
    files = at(target).getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at(source)):
        return False
    files.mkdirs(at(target).getParent())
    files.delete(at(target), True)
    if not files.rename(at(source), at(target)):
        raise OSError(f"{source} could not be moved to {target}")
    return True


def remove_folder(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def write_by_category(df: DataFrame, path: str, category: str = "category") -> str:
    """One folder per category.

    The rebalance gives each folder few files, and splits a category that holds
    much of the data over several tasks.
    """
    df.hint("rebalance", category).write.mode("overwrite").partitionBy(category).parquet(path)
    return path


def append_to_ledger(new_keys: DataFrame, path: str) -> str:
    """Add keys to the ledger without touching those it holds."""
    new_keys.write.mode("append").parquet(path)
    return path
