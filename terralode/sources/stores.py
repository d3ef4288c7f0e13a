"""File systems that tasks open by themselves."""

from __future__ import annotations

import sys

from pyarrow import fs
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# File systems a task opens by itself, by the scheme of Spark's path.
FILE_SYSTEMS = {"file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "abfs": "abfs", "abfss": "abfss"}


def require_file_system(path: str) -> None:
    """Refuse a path no task could open, before any job runs."""
    if not tasks_can_open(path):
        raise ValueError(f"tasks cannot open files on {path.partition(':')[0]}: {path}")


def tasks_can_open(path: str) -> bool:
    scheme, colon, _ = path.partition(":")
    return not colon or "/" in scheme or scheme in FILE_SYSTEMS


def file_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path's name there."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest or path).lstrip("/")
    # Only the store is named by a URI, so that a file's name may hold any character.
    store, _, key = rest.lstrip("/").partition("/")
    filesystem, root = fs.FileSystem.from_uri(f"{FILE_SYSTEMS[scheme]}://{store}/")
    return filesystem, f"{root.rstrip('/')}/{key}"
