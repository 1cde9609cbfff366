"""Key presence in a parsed JSON ``VARIANT``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vpresent(v: Column, path: str) -> Column:
    """Key exists. Its value may be JSON null: ``try_variant_get(v, path, 'variant')`` is a
    variant-null for a present JSON null and SQL NULL for a missing key."""
    return F.try_variant_get(v, path, "variant").isNotNull()
