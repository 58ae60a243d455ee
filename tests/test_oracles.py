"""Every registered query against its SQL oracle: columns, types and values."""

import pytest
from oracle_check import TEST_DATA, connect, oracle_result, spark_result, type_differences

import __spark_entry__ as entry_points
from subtide.plans.oracles import ORACLES
from subtide.plans.registry import QUERIES

SF_DIR = f"{TEST_DATA}/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    sql = ORACLES[name]
    assert type_differences(con, df, sql) == []
    found, wanted = spark_result(df), oracle_result(con, sql)
    assert found == wanted
    assert found[1]


def test_entry_is_the_flagship_query(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "month" and df.count() > 0


def test_unknown_query_name(spark):
    from subtide.plans.registry import run_query

    with pytest.raises(KeyError, match="no query named"):
        run_query("no_such_query", spark, SF_DIR)
