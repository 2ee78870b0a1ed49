"""Every registered query against its SQL oracle on the smallest tables."""

from __future__ import annotations

import os

import pytest

from oracle import compare, connect
from tarn.plans.cases import ALL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


@pytest.mark.parametrize("name", list(ALL))
def test_query(spark, connection, name):
    assert compare(spark, connection, name, ALL[name], SF) is None


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns
