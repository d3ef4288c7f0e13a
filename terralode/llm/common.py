"""What the operators share: working tables, and shipping their functions to the tasks."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from terralode.session import shared_dir

# Executors need not have the library: its task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written once to the shared folder and read back: lineage ends there, for any executor to read.

    The shuffles that made them go with the write; else they take disk until the driver collects its garbage.
    """
    spark: SparkSession = df.sparkSession
    path = shared_dir(spark, purpose)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
