"""Two-phase (slice, then border merge) sessionization against plain-Python
sessionization on random events and random slice widths."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from changeflow.streaming.windows import session_metrics

GAP = dt.timedelta(minutes=30)
T0 = dt.datetime(2024, 1, 1)


def brute_force(events):
    out = set()
    by_user = {}
    for u, t, v in events:
        by_user.setdefault(u, []).append((t, v))
    for u, evs in by_user.items():
        evs.sort()
        start, last, n, total = evs[0][0], evs[0][0], 1, Decimal(str(evs[0][1]))
        for t, v in evs[1:]:
            if t >= last + GAP:                      # no overlap with the previous event's window
                out.add((u, start, last + GAP, n, float(total)))
                start, n, total = t, 0, Decimal(0)
            last, n, total = max(last, t), n + 1, total + Decimal(str(v))
        out.add((u, start, last + GAP, n, float(total)))
    return out


events_st = st.lists(st.tuples(st.integers(1, 3), st.integers(0, 4 * 24 * 60), st.integers(1, 999)),
                     min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(events_st, st.sampled_from([600, 1800, 3600, 86_400]))
def test_sessions_match_brute_force(spark, raw, split):
    events = [(u, T0 + dt.timedelta(minutes=m), v / 100) for u, m, v in raw]
    df = spark.createDataFrame(events, "user_id long, ts timestamp_ntz, value double")
    got = {(r.user_id, r.session_start, r.session_end, r.events, r.total_value)
           for r in session_metrics(df, "30 minutes", split_seconds=split).collect()}
    assert got == brute_force(events)
