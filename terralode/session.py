"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_type

_LOCAL_ROOTS: dict[str, str] = {}


# What a shuffle partition should come to, so that a task sorts it in memory.
SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024
MIN_SHUFFLE_PARTITIONS = 200


def shuffle_partitions(input_bytes: int) -> int:
    """Partitions to shuffle an input of this size into; AQE merges them where less arrives, but never splits plain ones."""
    return max(MIN_SHUFFLE_PARTITIONS, -(-input_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(
    app_name: str = "terralode", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the library is tuned for; ``conf`` wins over them.

    ``input_bytes``, the size of the largest table to be shuffled, sets the number
    of shuffle partitions.
    """
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes or 0)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small literal table, part of the plan itself so that its size is known."""
    fields = T.StructType.fromDDL(schema).fields
    columns = list(zip(*rows)) or [()] * len(fields)
    arrays = [pa.array(list(c), type=to_arrow_type(f.dataType)) for c, f in zip(columns, fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=[f.name for f in fields]), schema)


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.conf.get("spark.app.id")
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = "file:" + tempfile.mkdtemp(prefix="terralode-")
    return _LOCAL_ROOTS[app]


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder; nothing is ever written twice to it."""
    return f"{shared_root(spark)}/terralode/{purpose}-{uuid.uuid4().hex}"
