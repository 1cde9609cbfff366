"""Change-event scalar expressions."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Change-event op codes (c, u, d, r) and the change labels they map to.
CHANGE_LABELS = {"c": "INSERT", "u": "UPDATE", "d": "DELETE", "r": "SNAPSHOT"}
UNKNOWN_LABEL = "UNKNOWN"


def change_label(op: Column) -> Column:
    """The label of an op code; anything else (NULL too) → UNKNOWN."""
    known = F.create_map(*[F.lit(x) for pair in CHANGE_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, op), F.lit(UNKNOWN_LABEL))


def message_operation(op: Column) -> Column:
    """Operation of the standard ETL message: u→UPDATE, d→DELETE, else INSERT."""
    return F.when(op == "u", "UPDATE").when(op == "d", "DELETE").otherwise("INSERT")


def decode_decimal_base64(encoded: Column, scale: int = 2) -> Column:
    """Decode a connector's base64 big-endian two's-complement unscaled decimal.

    'Jw8=' → 99.99, '2PE=' → -99.99 at scale 2. The result is
    ``decimal(38, scale)``; input that is not base64, empty, wider than 16 bytes
    or beyond 38 digits → NULL (:func:`changeflow.operators.cdc.flatten_envelope`
    rejects such rows by reason). Exact, built-ins only: the sign-extended hex
    digits are read as a signed high and an unsigned low 64-bit half by ``conv``.
    """
    def unscaled(raw: Column) -> Column:
        hexed = F.hex(raw)
        fill = F.when(F.substring(hexed, 1, 1) >= "8", "F").otherwise("0")         # the sign, extended
        extended = F.lpad(hexed, F.lit(32), fill)
        high = F.conv(F.substring(extended, 1, 16), 16, -10).cast("decimal(20,0)")
        low = F.conv(F.substring(extended, 17, 16), 16, 10).cast("decimal(20,0)")
        whole = F.try_add(F.try_multiply(high, F.lit(Decimal(1 << 64))), low)
        return F.when(F.octet_length(raw).between(1, 16), whole)

    def scaled(value: Column) -> Column:
        # The point is moved in the digits: a division would round.
        digits = F.regexp_replace(F.abs(value).cast("string"), "^", "0" * scale)
        text = F.concat(F.when(value < 0, "-").otherwise(""), F.regexp_replace(digits, f"(.{{{scale}}})$", ".$1"))
        return text.try_cast(f"decimal(38,{scale})")

    return _once(_once(F.try_to_binary(encoded, F.lit("base64")), unscaled), scaled)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


# Epoch units of event times that arrive as numbers, in microseconds, and the years 1 to 9999 in these.
EPOCH_UNITS = {"seconds": 1_000_000, "millis": 1_000, "micros": 1}
EPOCH_RANGE = (-62_135_596_800_000_000, 253_402_300_799_999_999)


def epoch_number(text: Column) -> Column:
    """Whether an event time is written as a number (four digits are a year)."""
    return text.rlike(r"^-?[0-9]{5,}$")


def parse_event_time(text: Column, epoch_unit: str = "micros") -> Column:
    """Timestamp from an epoch number (all digits, in ``epoch_unit``) or ISO-8601 / SQL text.

    The unit is the source's and never guessed from the number. Text follows
    Spark's timestamp cast rules: date only, ``T`` or space separator, 0-6
    fraction digits, optional ``Z`` / offset (converted to the session time
    zone). Unparseable text and numbers beyond the years 1 to 9999 → NULL.
    """
    if epoch_unit not in EPOCH_UNITS:
        raise ValueError(f"epoch_unit must be one of {sorted(EPOCH_UNITS)}")
    size = EPOCH_UNITS[epoch_unit]
    number = text.try_cast("bigint")
    fits = number.between(-(-EPOCH_RANGE[0] // size), EPOCH_RANGE[1] // size)
    return F.when(epoch_number(text), F.when(fits, F.timestamp_micros(F.try_multiply(number, F.lit(size))))).otherwise(
        F.try_to_timestamp(text))
