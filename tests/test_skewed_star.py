"""Every registered query against its oracle when one customer has a third of all orders,
one order a third of all lines and one user a third of all events."""

import duckdb
import pytest
from oracle_check import TEST_DATA, connect, oracle_result, spark_result

from subtide.plans.oracles import ORACLES
from subtide.plans.registry import QUERIES

HOT = {
    "orders": "o_custkey: CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END",
    "lineitem": "l_orderkey: CASE WHEN l_partkey % 3 = 0 THEN 5 ELSE l_orderkey END",
    "events": "user_id: CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END",
    "customer": None,
    "nation": None,
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name, change in HOT.items():
        columns = "*"
        if change:
            column, value = change.split(": ", 1)
            columns = f"* REPLACE (({value}) AS {column})"
        source = f"{TEST_DATA}/sf0.001/{name}.parquet"
        con.execute(f"COPY (SELECT {columns} FROM '{source}') TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def con(skewed):
    return connect(skewed)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle_on_skewed_tables(spark, skewed, con, name):
    found = spark_result(QUERIES[name](spark, skewed))
    assert found == oracle_result(con, ORACLES[name])
