"""Base64 two's-complement decimals: random values encoded as a connector would,
decoded by the Spark expression."""

import base64
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeflow.functions.cdc import decode_decimal_base64


def encode(unscaled: int) -> str:
    magnitude = unscaled if unscaled >= 0 else ~unscaled
    n = max(1, (magnitude.bit_length() + 8) // 8)          # minimal two's-complement width
    return base64.b64encode(unscaled.to_bytes(n, "big", signed=True)).decode()


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.integers(-(2 ** 63), 2 ** 63 - 1), st.sampled_from([-(2 ** 63), 2 ** 63 - 1, -1, 0, 128, -128, -129])),
                min_size=20, max_size=50))
def test_decode_matches_python(spark, values):
    df = spark.createDataFrame([(i, encode(v)) for i, v in enumerate(values)], "i long, s string")
    got = {r.i: r.d for r in df.select("i", decode_decimal_base64(F.col("s"), 2).alias("d")).collect()}
    for i, v in enumerate(values):
        assert got[i] == Decimal(v).scaleb(-2), (v, encode(v), got[i])
