"""Parquet files to catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from terralode.functions.names import has_suffix, safe_identifier
from terralode.plans.runner import run_each
from terralode.sinks.tables import declare_table, save_table
from terralode.sources.listing import list_keys, literal_path
from terralode.sources.registry import stem_of


NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def table_keys(listing: DataFrame, formats: Sequence[str] = (".parquet",)) -> DataFrame:
    """Keys that are tables: files with a wanted suffix, or the folders that hold them.

    Such a folder has the suffix itself, or is the ``table=<name>`` one of a shared write.
    """
    suffix = "|".join(f.replace(".", r"\.") for f in formats)
    folder = F.regexp_extract("key", rf"(?i)^(.*?(?:{suffix})|(?:.*/)?table=[^/]+)/", 1)
    wanted = listing.filter(has_suffix(F.col("key"), list(formats)))
    return wanted.select(F.when(folder != "", folder).otherwise(F.col("key")).alias("key")).distinct()


def table_of(key: str) -> str:
    return stem_of(key).removeprefix("table=").upper()


def load_parquets(
    spark: SparkSession,
    source: str,
    schema: str,
    formats: Sequence[str] = (".parquet",),
    workers: int = 7,
    in_place: bool = False,
) -> DataFrame:
    """One table per Parquet key, created or replaced, named by the upper-cased stem.

    ``in_place`` declares tables over the files where they lie and copies no data, but for
    tables with nested columns, which are written anew as JSON texts, and for paths with
    signs of a pattern, which the catalog would not take as they are. A key that fails is reported with its error and left out of the tables; so are
    keys whose differing names come to the same one in the catalog.
    """
    listed = table_keys(list_keys(spark, source), formats).orderBy("key")
    keys = [row["key"] for row in listed.toLocalIterator()]
    names: dict[str, set[str]] = {}
    for key in keys:
        names.setdefault(safe_identifier(table_of(key)), set()).add(table_of(key))

    def load(key: str) -> list[str]:
        rivals = names[safe_identifier(table_of(key))]
        if len(rivals) > 1:
            raise ValueError(f"tables {sorted(rivals)} would have one name")
        place = f"{source.rstrip('/')}/{key}"
        rows = spark.read.parquet(literal_path(place))
        if in_place and literal_path(place) == place and not any(isinstance(f.dataType, NESTED) for f in rows.schema):
            return [declare_table(rows, place, schema, table_of(key))]
        return [save_table(rows, schema, table_of(key))]

    # Keys of one name replace one another: one at a time, the last one stays.
    return run_each(spark, keys, load, workers, lane=table_of)


def created_tables(results: DataFrame) -> DataFrame:
    return results.filter("ok").select("table")
