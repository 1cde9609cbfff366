"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from changeflow.plans import registry
from conftest import SF0001
from tools.check_oracle import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, con, name):
    msg = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF0001)
    assert ": OK" in msg, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_id", "order_count", "total_quantity", "total_value", "avg_order_value",
                          "last_order_date"]
    assert len(df.collect()) == 10
