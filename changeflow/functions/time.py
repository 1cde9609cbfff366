"""Time anchors and window predicates.

The reference anchors its windows at ``NOW()`` / ``CURRENT_DATE``. Here the
anchor is the ``as_of`` argument so results are reproducible:

* ``None``      – the wall clock (``localtimestamp()``, session time zone);
* ``"latest"``  – the newest ``order_date`` of the input itself, evaluated as
  an uncorrelated scalar subquery (one small aggregate job, then a literal in
  the main plan — no join and nothing collected in Python); on a table
  partitioned by ``order_day`` only the newest day's data is read for it;
* a ``datetime`` / ISO string – that instant;
* a ``Column`` – used as is.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Day column of an orders table (see warehouse.write_orders_by_day).
DAY_PARTITION = "order_day"


def resolve_as_of(df: DataFrame, as_of, ts_col: str = "order_date", day_col: str = DAY_PARTITION) -> Column:
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str) and as_of == "latest":
        if day_col in df.columns:
            # Find the newest day from the day column (on a partitioned table
            # from its folders), then read only that day for the exact maximum.
            last_day = df.select(F.max(day_col)).scalar()
            return df.where(F.col(day_col) >= last_day).select(F.max(ts_col)).scalar()
        return df.select(F.max(ts_col)).scalar()
    if isinstance(as_of, (_dt.datetime, _dt.date, str)):
        return F.lit(as_of).cast("timestamp_ntz")
    raise TypeError(f"unsupported as_of {as_of!r}")


def since_day_start(ts: Column, anchor: Column, days: int) -> Column:
    """``ts >= CURRENT_DATE - N days``: midnight-aligned, up to N+1 calendar dates."""
    return ts >= F.date_sub(F.to_date(anchor), int(days)).cast("timestamp_ntz")


def since_minutes(ts: Column, anchor: Column, minutes: int) -> Column:
    """``ts >= NOW() - N minutes`` (no upper bound, as in the reference)."""
    return ts >= anchor - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(int(minutes)))


def same_day(ts: Column, day: Column, ts_type: str = "timestamp_ntz") -> Column:
    """``DATE(ts) = day`` written as a range on the bare column (bounds cast to
    the column's type, ``timestamp_ntz`` or ``timestamp``) so it stays a
    pushable predicate."""
    start = F.to_date(day).cast(ts_type)
    return (ts >= start) & (ts < F.date_add(F.to_date(day), 1).cast(ts_type))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Fractional seconds from ``earlier`` to ``later`` (double)."""
    micros = (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp")))
    return micros.cast("double") / F.lit(1_000_000.0)


def last_days(df: DataFrame, anchor: Column, days: int, ts_col: str = "order_date") -> DataFrame:
    """Rows of the last ``days`` calendar days before ``anchor`` (midnight aligned).

    When ``df`` carries the ``order_day`` partition column the implied bound
    on it is added too, so a day-partitioned table is pruned to those days
    instead of being scanned whole.
    """
    out = df.where(since_day_start(F.col(ts_col), anchor, days))
    if DAY_PARTITION in df.columns:
        out = out.where(F.col(DAY_PARTITION) >= F.date_sub(F.to_date(anchor), int(days)))
    return out


def last_minutes(df: DataFrame, anchor: Column, minutes: int, ts_col: str = "order_date") -> DataFrame:
    """Rows of the last ``minutes`` minutes before ``anchor`` (partition-pruned as above)."""
    out = df.where(since_minutes(F.col(ts_col), anchor, minutes))
    if DAY_PARTITION in df.columns:
        start = anchor - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(int(minutes)))
        out = out.where(F.col(DAY_PARTITION) >= F.to_date(start))
    return out
