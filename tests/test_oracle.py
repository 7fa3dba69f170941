"""Every registered query equals its DuckDB oracle (the driver's check) at sf0.001."""

import os

import pytest

import __spark_entry__ as E
from oracle_check import check, duck

SF = os.environ.get("STELLATE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_query_matches_oracle(spark, con, key):
    res = check(spark, key, SF, con)
    if key in E.oracle_sql():
        assert res["cols_match"], res
        assert res["values_match"], res
    else:
        assert res["spark_rows"] >= 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[0] == "profile_id"
