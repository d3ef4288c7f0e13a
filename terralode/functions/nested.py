"""JSON and coordinate texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def json_keys(text: Column) -> Column:
    """A JSON array of texts; an unreadable or missing one counts as empty."""
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))


def json_field(text: Column, field: str, default: str = "") -> Column:
    """One field of a JSON object as text; ``default`` when absent or unreadable."""
    return F.coalesce(F.get_json_object(text, f"$.{field}"), F.lit(default))


def coordinates(text: Column) -> Column:
    """``lon,lat[,alt]`` tuples separated by whitespace, as arrays of doubles."""
    tuples = F.filter(F.split(text, r"\s+"), lambda t: t != "")
    return F.transform(tuples, lambda t: F.transform(F.split(t, ","), lambda v: v.try_cast("double")))
