"""Gates: conditions that stop a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


class GateError(ValueError):
    """A gate found its condition broken."""


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Stop when there is no row; looks for the first one only."""
    if df.isEmpty():
        raise GateError(message)
    return df


def require_value(df: DataFrame, col: str, message: str) -> DataFrame:
    """Stop when any row lacks a value."""
    if not df.filter(F.col(col).isNull() | (F.col(col) == "")).isEmpty():
        raise GateError(message)
    return df


def require_positive(df: DataFrame, total: Column, message: str) -> DataFrame:
    """Stop when a total is missing or not above zero."""
    value = df.agg(total.alias("total")).first()["total"]
    if not value or value <= 0:
        raise GateError(message)
    return df


def require_not_all_failed(results: DataFrame, message: str, outcome: str = "outcome") -> DataFrame:
    """Stop only when there were errors and nothing at all was fetched."""
    row = results.agg(
        F.count_if(F.col(outcome) == "error").alias("errors"), F.count_if(F.col(outcome) == "ok").alias("ok")
    ).first()
    if row["errors"] and not row["ok"]:
        raise GateError(message)
    return results


def require_no_failures(results: DataFrame, message: str, ok: str = "ok") -> DataFrame:
    """Stop when any item failed, once all have been tried."""
    failures = results.filter(~F.col(ok))
    n = failures.count()
    if n:
        raise GateError(f"{message}: {n} failed")
    return results


def assert_rows(df: DataFrame, condition: Column, message: str | Column) -> DataFrame:
    """Lazy form: the job itself fails on the first row that breaks the condition."""
    checked = F.assert_true(condition, F.lit(message))
    return df.withColumn("_checked", checked).filter(F.col("_checked").isNull()).drop("_checked")
