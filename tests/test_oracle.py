"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_points
from tests.compare import difference, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    texts = set(entry_points.text_queries.queries()) if entry_points.text_queries else set()
    # what SQL can't express is held against brute force in the tests of the text operators
    assert set(entry_points.queries()) - set(entry_points.oracle_sql()) <= texts


@pytest.mark.parametrize("key", sorted(entry_points.oracle_sql()))
def test_query(spark, con, key):
    assert difference(entry_points.queries()[key](spark, SF_DIR), con, entry_points.oracle_sql()[key]) is None


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["symbol", "ort_yillik_getiri_pct"]
