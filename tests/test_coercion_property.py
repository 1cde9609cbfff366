"""Property check of the tolerant coercion against a plain-Python statement of
the semantics (float()/int() with defaults; absent keys stay absent)."""

import json
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeflow.operators import cdc as C

MISSING = object()


def expected(value, default, conv):
    if value is MISSING:
        return None
    try:
        return conv(value)
    except (TypeError, ValueError):
        return default


def as_int(v):
    return int(v)


def as_float(v):
    return float(v)


number_text = st.one_of(st.integers(-10**6, 10**6).map(str),
                        st.decimals(-10**6, 10**6, places=3, allow_nan=False).map(str),
                        st.integers(-999, 999).map(lambda i: f" {i} "))
junk = st.sampled_from(["x", "", "invalid", "1,5", "12abc", "--1", "1.2.3"])
values = st.one_of(st.just(MISSING), st.none(), st.booleans(), st.integers(-2**62, 2**62),
                   st.floats(-1e9, 1e9, allow_nan=False, allow_infinity=False), number_text, junk)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(values, values), min_size=20, max_size=40))
def test_price_and_quantity_coercion(spark, cases):
    rows = []
    for i, (price, qty) in enumerate(cases):
        rec = {"id": i, "customer_id": 1, "product_id": "P"}
        if price is not MISSING:
            rec["price"] = price
        if qty is not MISSING:
            rec["quantity"] = qty
        rows.append((i, json.dumps({"payload": {"op": "c", "after": rec}})))
    df = spark.createDataFrame(rows, "event_id long, value string").withColumn("ts", F.localtimestamp())
    got = {r.event_id: r for r in C.payload_records(df).collect()}
    for i, (price, qty) in enumerate(cases):
        r = got[i]
        assert r.reject_reason is None
        want_p = expected(price, 0.0, as_float)
        want_q = expected(qty, 1, as_int)
        assert (r.price is None) == (want_p is None), (price, r.price)
        if want_p is not None:
            assert math.isclose(r.price, want_p, rel_tol=1e-12, abs_tol=1e-12), (price, r.price, want_p)
        assert r.quantity == want_q, (qty, r.quantity, want_q)
        if want_p is None or want_q is None:
            assert r.total_amount is None
        else:
            assert math.isclose(r.total_amount, want_p * want_q, rel_tol=1e-12, abs_tol=1e-9)
