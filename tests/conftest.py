import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terralode.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as sorted tuples, columns by name."""

    def collect(df, *columns):
        names = columns or sorted(df.columns)
        return sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=repr)

    return collect


@pytest.fixture
def schema(spark):
    """A fresh schema for a test's tables."""
    from terralode.queries.models import fresh_schema

    return fresh_schema(spark, "test")[0]
