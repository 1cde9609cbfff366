"""The driver contract: every query has an oracle (or is a documented
exception), names are unique, and the oracles never use a row cap except the
top-k / bounded-consumer features."""

import re

import __spark_entry__ as E

from changeflow.plans import registry

# The library's own queries; optional ones registered beside them have their own tests.
OWN = set(registry.queries())
LIMIT_IS_THE_FEATURE = {"top_customers", "product_performance", "recent_trend_head", "consume_bounded", "param_sql",
                        "insights_bundle"}


def test_every_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and OWN <= set(q)
    assert OWN <= set(o)
    assert len(OWN) >= 58


def test_no_row_caps_outside_the_features():
    for name, sql in registry.oracle_sql().items():
        if re.search(r"\bLIMIT\b", sql, re.I):
            assert name in LIMIT_IS_THE_FEATURE, name


def test_every_query_reads_the_given_tables(spark):
    from conftest import SF0001
    # These read what Spark wrote from the given tables.
    derived = {"insights_bundle", "warehouse_append", "warehouse_compacted", "anomalies_from_moments", "customers_by_range",
               "late_rows", "alert_metrics"}
    for name, fn in registry.queries().items():
        files = fn(spark, SF0001).inputFiles()
        assert files and (name in derived or all("/root/testdata/sf0.001/" in f for f in files)), name
