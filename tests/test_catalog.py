"""Every named query against its SQL, and the driver contract."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as contract  # noqa: E402
import compare  # noqa: E402
from barloom.plans import catalog, oracle  # noqa: E402

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert catalog.QUERIES.keys() == oracle.oracles().keys()
    assert catalog.QUERIES.keys() <= contract.queries().keys()


def test_entry(spark):
    df = contract.entry(spark)
    assert {"symbol", "timestamp", "rsi", "vwap"} <= set(df.columns)
    assert df.count() > 0


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_query_agrees_with_sql(spark, con, name):
    ok, note = compare.compare(spark, con, name, SF)
    assert ok, note
