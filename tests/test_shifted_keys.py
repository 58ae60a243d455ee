"""Keys longer than any fixed width: every query on tables whose keys are shifted beyond it."""

import duckdb
import pytest
from oracle_check import TEST_DATA, connect, oracle_result, spark_result

from subtide.plans.oracles import ORACLES
from subtide.plans.registry import QUERIES

# Multiples of all moduli that the adapters take of keys, so nothing but the keys changes.
USERS, ORDERS = 10**8, 2_900 * 4_000_000
SHIFTS = {
    "customer": f"c_custkey + {USERS} AS c_custkey",
    "orders": f"o_custkey + {USERS} AS o_custkey, o_orderkey + {ORDERS} AS o_orderkey",
    "lineitem": f"l_orderkey + {ORDERS} AS l_orderkey",
    "events": f"user_id + {USERS} AS user_id",
    "nation": None,
}
# Without ids in the result, and without the planted errors that go by other moduli of keys.
WITHOUT_IDS = [
    n for n in QUERIES if not n.startswith(("segment_", "campaign_audience", "campaign_segments", "campaign_labels", "send_records", "account_age")) and not n.endswith("_dirty")
]


def copied(folder, changes):
    con = duckdb.connect()
    for name, change in changes.items():
        columns = f"* REPLACE ({change})" if change else "*"
        con.execute(f"COPY (SELECT {columns} FROM '{TEST_DATA}/sf0.001/{name}.parquet') TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def shifted(tmp_path_factory):
    return copied(tmp_path_factory.mktemp("shifted"), SHIFTS)


@pytest.fixture(scope="module")
def con(shifted):
    return connect(shifted)


@pytest.mark.parametrize("name", list(QUERIES))
def test_long_keys_match_the_oracle(spark, shifted, con, name):
    found = spark_result(QUERIES[name](spark, shifted))
    assert found == oracle_result(con, ORACLES[name])
    if name in WITHOUT_IDS:
        assert found == spark_result(QUERIES[name](spark, f"{TEST_DATA}/sf0.001"))


@pytest.mark.parametrize("name", ["funnel_report", "time_to_convert", "lead_overview", "mrr_monthly"])
def test_orders_of_late_years(spark, tmp_path, name):
    late = "CASE WHEN o_custkey % 2 = 0 THEN o_orderdate + INTERVAL 62 YEAR ELSE o_orderdate END AS o_orderdate"
    folder = copied(tmp_path, {**dict.fromkeys(SHIFTS), "orders": late})
    assert spark_result(QUERIES[name](spark, folder)) == oracle_result(connect(folder), ORACLES[name])
