"""Values computed for the fixture views (FIXTURES.md §2-§3) at sf0.001."""

from decimal import Decimal

from pyspark.sql import functions as F

from changeflow.operators import analytics as A
from changeflow.operators import cdc as C
from changeflow.sources import fixtures as X
from conftest import SF0001


def test_order_lines_shape(spark):
    o = X.order_lines(spark, SF0001)
    st = {r.status: r["count"] for r in o.groupBy("status").count().collect()}
    assert st == {"cancelled": 1968, "confirmed": 1411, "delivered": 699, "pending": 1284, "shipped": 638}
    s = A.order_summary(o).collect()[0]
    assert (s.total_orders, s.unique_customers, s.unique_products) == (4032, 150, 200)
    assert Decimal(str(s.total_revenue)) == Decimal("5367486151.19")
    assert str(s.latest_order) == "2001-08-01 07:03:46"


def test_top_customer(spark):
    t = A.top_customers(X.order_lines(spark, SF0001), 10).collect()[0]
    assert (t.customer_id, t.order_count, t.total_quantity) == (10, 42, 1211)
    assert abs(t.total_value - 82206223.66) < 1e-6


def test_anomaly_branches(spark):
    o = X.order_lines(spark, SF0001)

    def counts(k, sd, cd):
        a = A.detect_anomalies(o, k, stats_days=sd, candidate_days=cd, as_of="latest")
        return {r.anomaly_type: r["count"] for r in A.anomaly_counts(a).collect()}
    assert counts(2.0, 7, 1) == {}
    assert counts(1.0, 7, 1) == {"Low Value": 1}
    assert counts(1.0, 90, 30) == {"High Value": 16, "High Quantity": 13, "Low Value": 10}


def test_cdc_counts(spark):
    rec = C.payload_records(X.cdc_raw(spark, SF0001))
    assert rec.count() == 1000
    assert C.decode_payload(X.cdc_raw(spark, SF0001)).where("reject_reason IS NULL").count() == 770
    ok = C.accepted(rec).groupBy("_cdc_operation").agg(F.count(F.lit(1)).alias("n"),
                                                      F.round(F.sum("total_amount"), 2).alias("s"))
    got = {r._cdc_operation: (r.n, r.s) for r in ok.collect()}
    assert got == {"c": (191, 28190.51), "u": (382, 54341.56), "d": (190, 24496.2)}
    env = C.flatten_envelope(C.decode_envelope(X.envelope_raw(spark, SF0001)))
    labels = {r.change_type: r["count"] for r in env.groupBy("change_type").count().collect()}
    assert labels == {"INSERT": 193, "UPDATE": 385, "DELETE": 192, "SNAPSHOT": 192, "UNKNOWN": 38}


def test_approx_summary_close_to_exact(spark):
    o = X.order_lines(spark, "/root/testdata/sf0.01")
    exact = A.order_summary(o).collect()[0]
    approx = A.order_summary_approx(o, rsd=0.01).collect()[0]
    assert approx.total_orders == exact.total_orders and approx.total_revenue == exact.total_revenue
    for c in ("unique_customers", "unique_products"):
        assert abs(approx[c] - exact[c]) <= 0.05 * exact[c]
