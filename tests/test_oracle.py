"""Every registered query against its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from tools.check_oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, SF, con, verbose=True)
    if name in E.oracle_sql():
        assert res["match"], res
    else:
        assert res["spark_rows"] >= 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
