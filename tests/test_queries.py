"""Every registered query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry
from terralode.queries import ORACLES, QUERIES
from tools.check_oracles import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    ok, note = compare(spark, duck, SF_DIR, name)
    assert ok, note


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0
