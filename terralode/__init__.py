"""terralode: open-data files to clean, queryable tables, as Spark jobs."""

from terralode.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
