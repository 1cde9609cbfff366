"""Column-expression helpers (each returns a ``Column``; no Python UDFs)."""

from changeflow.functions.time import (
    resolve_as_of, since_day_start, since_minutes, seconds_between, same_day,
)
from changeflow.functions.cdc import (
    change_label, decode_decimal_base64, parse_event_time, message_operation,
)
from changeflow.functions.coerce import vpresent

__all__ = [
    "resolve_as_of", "since_day_start", "since_minutes", "seconds_between", "same_day",
    "change_label", "decode_decimal_base64", "parse_event_time", "message_operation", "vpresent",
]
