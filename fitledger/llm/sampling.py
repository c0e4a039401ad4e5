"""Seeded draws of about so many rows, for models that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASH_SPAN = 1 << 63


def threshold(limit: int, rows: int) -> int:
    """Hashes of 63 bits below this are ``limit`` of ``rows`` on average, however many rows there are."""
    return HASH_SPAN - 1 if rows <= limit else max(1, limit * HASH_SPAN // rows)


def drawn(order: Column, limit: int, rows: Column) -> Column:
    """The same where the number of rows is a column."""
    share = F.least(F.lit(1.0), F.lit(float(limit)) / rows)
    return hash63(order) <= (share * F.lit(float(HASH_SPAN - 1024))).cast("long")


def hash63(order: Column) -> Column:
    return order.bitwiseAND(F.lit(HASH_SPAN - 1))
