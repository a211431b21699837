"""Operators that SQL can express against their DuckDB twins, on whole tables."""

import pytest

from lshark.llm import queries
from oracle_check import duck

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle()))
def test_query_matches_its_twin(spark, name):
    got = queries.QUERIES[name](spark, SMALL)
    cols = sorted(got.columns)
    found = duck(SMALL).execute(f"SELECT {', '.join(cols)} FROM ({queries.oracle()[name]})")
    assert sorted(map(repr, (tuple(r) for r in got.select(cols).collect()))) == sorted(map(repr, found.fetchall()))


def test_all_ten_are_registered():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 11)}
