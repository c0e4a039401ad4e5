"""Which logged values count as numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The variant types a metric may have. Booleans are numbers here,
# digits inside a string are not.
NUMERIC_TYPES = ["BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "BOOLEAN"]


def is_number(value: Column) -> Column:
    """True for a numeric or boolean variant; text, nested values and null are dropped."""
    return F.substring_index(F.schema_of_variant(value), "(", 1).isin(NUMERIC_TYPES)


def number_of(value: Column) -> Column:
    """A variant for which :func:`is_number` holds, as a double."""
    return F.try_variant_get(value, "$", "double")
