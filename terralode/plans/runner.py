"""Independent jobs run side by side, a failing one reported and not fatal."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from terralode.session import local_rows

RESULT_SCHEMA = "key string, table string, ok boolean, error string"


def run_each(
    spark: SparkSession,
    items: Iterable[str],
    job: Callable[[str], list[str]],
    workers: int = 7,
    lane: Callable[[str], str] = str,
) -> DataFrame:
    """Run ``job(key)`` per key; one result row per table it made, or one with its error.

    The jobs share the cluster: Spark schedules their tasks next to one another.
    Keys of one ``lane`` run one after the other, in order.
    """

    def attempt(key: str) -> list[tuple[str, str | None, bool, str | None]]:
        try:
            return [(key, table, True, None) for table in job(key)] or [(key, None, True, None)]
        except Exception as problem:
            return [(key, None, False, f"{type(problem).__name__}: {problem}")]

    lanes: dict[str, list[str]] = {}
    for item in items:
        lanes.setdefault(lane(item), []).append(item)
    in_turn = lambda keys: [row for key in keys for row in attempt(key)]
    with ThreadPoolExecutor(max_workers=workers) as pool:
        rows = [row for found in pool.map(inheritable_thread_target(spark)(in_turn), lanes.values()) for row in found]
    return local_rows(spark, rows, RESULT_SCHEMA)
