"""Every registered query against its DuckDB oracle on the smallest tables, plus the smoke
entry. (The driver repeats the oracle comparison at sf0.01.)"""

import pytest

import __spark_entry__ as E
from slipflow.plans.catalog import QUERIES
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() == 37
    assert len(df.columns) == 24


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    oracle = E.oracle_sql().get(name)
    if oracle is None:
        assert df.count() >= 0
        return
    n_spark, n_duck, problems = compare(df, con, oracle)
    assert not problems, problems


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())
