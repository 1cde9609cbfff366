"""Current-state application against a brute-force fold, in batch and through
the snapshot writer with changes arriving out of order across batches."""

import os
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from changeflow.operators.cdc import current_state
from changeflow.streaming.state import CurrentStateWriter, read_current_state

changes_st = st.lists(st.tuples(st.integers(1, 6), st.sampled_from(["c", "u", "d", "r"]), st.integers(0, 99)),
                      min_size=1, max_size=40)


def brute_force(rows):
    latest = {}
    for seq, (key, op, val) in enumerate(rows):
        latest[key] = (seq, op, val)
    return {k: v for k, (_, op, v) in latest.items() if op != "d"}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(changes_st, st.integers(1, 4), st.randoms(use_true_random=False))
def test_current_state_matches_fold(spark, rows, n_batches, rnd):
    data = [(seq, k, op, v) for seq, (k, op, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "seq long, id long, op string, val long")
    want = brute_force(rows)
    got = {r.id: r.val for r in current_state(df, "id", ["seq"], columns=["val"]).collect()}
    assert got == want
    # the same changes, shuffled and split into micro-batches: order of arrival must not matter
    shuffled = data[:]
    rnd.shuffle(shuffled)
    path = tempfile.mkdtemp(prefix="state-prop-")
    writer = CurrentStateWriter(os.path.join(path, "s"), key="id", order_by=["seq"], columns=["val"])
    size = max(1, len(shuffled) // n_batches + 1)
    for b, i in enumerate(range(0, len(shuffled), size)):
        writer(spark.createDataFrame(shuffled[i:i + size], df.schema), b)
    live = {r.id: r.val for r in read_current_state(spark, os.path.join(path, "s")).collect()}
    assert live == want
