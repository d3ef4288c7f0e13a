"""Value cleaning: the templates silver columns are built from."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Texts a delimited reader takes for a missing value.
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


def named(name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_strings(col: Column) -> Column:
    """Trim spaces, lower, and turn the empty text into null."""
    return F.nullif(F.lower(F.trim(col)), F.lit(""))


def cast_numbers(col: Column, data_type: str) -> Column:
    """Cast to a number; what does not parse becomes null."""
    return col.try_cast(data_type)


def cast_dates(col: Column, data_type: str = "date") -> Column:
    """Cast to a date or timestamp; what does not parse becomes null."""
    return col.try_cast(data_type)


def clean_booleans(col: Column) -> Column:
    """Cast to boolean; what does not parse becomes null."""
    return col.try_cast("boolean")


def normalize_nulls(col: Column) -> Column:
    """The exact text ``null`` becomes null."""
    return F.nullif(col, F.lit("null"))


def na_to_null(col: Column, tokens: list[str] = NA_TOKENS) -> Column:
    """Missing-value texts become null; the value is compared as it stands."""
    return F.when(~col.isin(tokens), col)
