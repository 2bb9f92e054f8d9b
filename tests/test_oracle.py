"""Every registered query against its DuckDB oracle (sf0.001 by default;
FARESPARK_TEST_SF=/root/testdata/sf0.01 for the driver's scale)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from farespark.plans.registry import REGISTRY
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    """Queries of the optional part need none: those without SQL are tested against brute force beside it."""
    assert set(REGISTRY) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF_SMALL)
    assert r["status"] == "ok", r
