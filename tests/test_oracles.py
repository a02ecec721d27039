"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os

import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare, duck

SF = os.environ.get("LEDGERLOOM_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    from ledgerloom.plans.queries import QUERIES as OWN

    assert set(OWN) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    problems, _, _, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert not problems, problems


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "account_id" and df.count() > 0
