"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import SMOKE_DIR, entry
from testbed.catalogue import QUERIES
from testbed.oracle import ORACLE
from tools.compare import compare, connect

pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(SMOKE_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_sql(spark, duck, name):
    assert compare(spark, duck, SMOKE_DIR, name) is None


def test_entry_has_rows(spark):
    assert entry(spark).columns == ["state", "total_revenue", "total_orders", "total_customers"]
    assert entry(spark).limit(1).count() == 1
