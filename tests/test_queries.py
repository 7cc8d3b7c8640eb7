"""Every query of the library against its SQL on the smallest driver tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from tests.oracle import compare, connect
from tidemark.workload import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "ticker" in df.columns
