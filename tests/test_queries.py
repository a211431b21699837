"""Every registered query against its DuckDB twin at sf0.001 (the driver
repeats this at sf0.01)."""

import pytest

from conftest import SF_SMALL
from oracle_check import compare, duck

import __spark_entry__ as entry_mod
from lshark.plans import catalog

QUERIES = catalog.queries()
ORACLE = catalog.oracle()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), ORACLE[name], SF_SMALL, con)
    assert ok, f"{name}: {msg}"


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["u", "i", "score", "rank"]
    assert df.count() > 0
