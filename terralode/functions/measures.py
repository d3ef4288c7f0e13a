"""Sizes, durations, text counts, pixel positions and labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Units of a readable size, each 1024 times the one before.
SIZE_UNITS = ["B", "KB", "MB", "GB", "TB", "PB"]

# Runs of anything but Unicode whitespace and the four information separators.
WORD_PATTERN = r"(?U)[^\s\x1C-\x1F]+"


def bytes_human(n: Column) -> Column:
    """Size with two decimals and the largest unit that keeps it below 1024."""
    size = n.cast("double")
    out = None
    for power in reversed(range(len(SIZE_UNITS))):
        scaled = (size / F.lit(float(1024**power))).cast("decimal(38,18)")
        text = F.concat(F.bround(scaled, 2).cast("decimal(38,2)").cast("string"), F.lit(" " + SIZE_UNITS[power]))
        if out is None:
            out = text
        else:
            out = F.when(size < float(1024 ** (power + 1)), text).otherwise(out)
    return out


def duration_seconds(start: Column, end: Column) -> Column:
    """Seconds from start to end; null while either is missing."""
    return (end - start).cast("interval second").cast("decimal(20,6)").cast("double")


def char_count(text: Column) -> Column:
    return F.length(text)


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; 0 for blank text."""
    return F.regexp_count(text, F.lit(WORD_PATTERN))


def is_blank(text: Column) -> Column:
    """Whether a text holds no word; stops at the first one."""
    return ~text.rlike(WORD_PATTERN)


def timestamp_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def now_text() -> Column:
    return timestamp_text(F.current_timestamp())


def pixel_centre(index: Column, origin: Column | float, step: Column | float) -> Column:
    """Coordinate of the centre of a pixel along one axis."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    return as_col(origin) + (index + F.lit(0.5)) * as_col(step)


def labels(*rules: tuple[Column, str], default: str) -> Column:
    """Labels of the rules that hold, in order; ``default`` alone when none does."""
    found = F.array_compact(F.array(*[F.when(test, F.lit(label)) for test, label in rules]))
    return F.when(F.size(found) == 0, F.array(F.lit(default))).otherwise(found)
