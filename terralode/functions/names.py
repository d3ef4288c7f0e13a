"""Names derived from object keys, URLs and run ids."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Basename with a suffix after at least one character that is not a dot.
STEM_PATTERN = r"^(\.*[^.].*)\.[^.]*$"
# Scheme and host, then parameters, query and fragment, of a URL.
URL_HOST_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*"
URL_TAIL_PATTERN = r"(;[^/?#]*)?([?#].*)?$"
URL_SUFFIX_PATTERN = r"^\.*[^.].*\.([^.]*)$"


def basename(key: Column) -> Column:
    return F.substring_index(key, "/", -1)


def file_extension(key: Column) -> Column:
    """Text after the last dot, lower-cased; empty when there is no dot."""
    return F.when(key.contains("."), F.lower(F.substring_index(key, ".", -1))).otherwise(F.lit(""))


def table_name(key: Column) -> Column:
    """Basename without its last suffix."""
    return F.regexp_replace(basename(key), STEM_PATTERN, "$1")


def parquet_key(key: Column, prefix: str = "parquets_files/") -> Column:
    """Where the table of a file is written."""
    return F.concat(F.lit(prefix), table_name(key), F.lit(".parquet"))


def url_path(url: Column) -> Column:
    """Path of a URL, also of one that a strict parser rejects."""
    return F.regexp_replace(F.regexp_replace(url, URL_HOST_PATTERN, ""), URL_TAIL_PATTERN, "")


def url_extension(url: Column) -> Column:
    """Lower-cased suffix of the last path segment, without the dot; empty when there is none."""
    return F.coalesce(F.lower(F.regexp_extract(basename(url_path(url)), URL_SUFFIX_PATTERN, 1)), F.lit(""))


def url_basename(url: Column, default: str = "downloaded_file") -> Column:
    """Last path segment of a URL, trailing slashes aside; ``default`` when empty."""
    last = basename(F.regexp_replace(url_path(url), r"/+$", ""))
    return F.coalesce(F.nullif(last, F.lit("")), F.lit(default))


def sanitize_run_id(run_id: Column) -> Column:
    """Everything but letters, digits, underscore and hyphen becomes an underscore."""
    return F.regexp_replace(F.coalesce(run_id, F.lit("")), r"(?U)[^\w\-]", "_")


def strip_suffix(name: Column, suffix: str) -> Column:
    """Name inside a compressed file: the suffix goes, else ``.decompressed`` is added."""
    inner = name.substr(F.lit(1), F.length(name) - len(suffix))
    return F.when(name.endswith(suffix), inner).otherwise(F.concat(name, F.lit(".decompressed")))


def inner_extension(name: Column) -> Column:
    """Extension of a decompressed name; a bare name is read as text."""
    return F.when(name.contains("."), file_extension(name)).otherwise(F.lit("txt"))


def resource_path(category: Column, ext: Column) -> Column:
    """Folder a resource is filed under."""
    return F.concat(category, F.lit("/"), ext, F.lit("/"))


def strip_prefix(key: Column, prefix: str) -> Column:
    return F.when(key.startswith(prefix), key.substr(F.lit(len(prefix) + 1), F.length(key))).otherwise(key)


def top_folder(key: Column, prefix: str = "") -> Column:
    """First folder after the prefix; ``root`` for keys that sit directly under it."""
    rest = strip_prefix(key, prefix)
    return F.when(rest.contains("/"), F.substring_index(rest, "/", 1)).otherwise(F.lit("root"))


def is_folder_key(key: Column) -> Column:
    return key.endswith("/")


def has_suffix(key: Column, suffixes: list[str]) -> Column:
    """Case-insensitive test against any of several suffixes."""
    test = F.lit(False)
    for suffix in suffixes:
        test = test | F.lower(key).endswith(suffix.lower())
    return test


def safe_identifier(name: str) -> str:
    """A table name the catalog accepts."""
    return re.sub(r"[^A-Za-z0-9_]", "_", name)


def safe_identifier_column(name: Column) -> Column:
    return F.regexp_replace(name, r"[^A-Za-z0-9_]", "_")


def unique_names(names: list[str | None], case_sensitive: bool = False) -> list[str]:
    """Header names made usable: blanks numbered, repeats suffixed."""
    seen: set[str] = set()
    out = []
    for i, raw in enumerate(names):
        base = (raw or "").lstrip("\ufeff") or f"Unnamed: {i}"
        name, n = base, 0
        while (name if case_sensitive else name.lower()) in seen:
            n += 1
            name = f"{base}.{n}"
        seen.add(name if case_sensitive else name.lower())
        out.append(name)
    return out
