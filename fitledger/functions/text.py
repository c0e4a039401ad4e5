"""Null handling, Unicode-aware stripping, and the user turn of an example."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters Python's str.strip() and str.split() treat as
# whitespace, as inclusive code point ranges.
WHITESPACE_RANGES = [
    (0x0009, 0x000D),
    (0x001C, 0x0020),
    (0x0085, 0x0085),
    (0x00A0, 0x00A0),
    (0x1680, 0x1680),
    (0x2000, 0x200A),
    (0x2028, 0x2029),
    (0x202F, 0x202F),
    (0x205F, 0x205F),
    (0x3000, 0x3000),
]
# Fixed value: what separates an instruction from its input in the user turn.
INPUT_HEADING = "\n\n[入力]\n"

WHITESPACE = "".join(
    chr(point) for first, last in WHITESPACE_RANGES for point in range(first, last + 1)
)


def null_to_empty(col: Column) -> Column:
    """Null becomes the empty string."""
    return F.coalesce(col, F.lit(""))


def first_present(*cols: Column) -> Column:
    """The first non-null of several values, as in a pad id that falls back to the end id."""
    return F.coalesce(*cols)


def py_strip(col: Column) -> Column:
    """Strip Unicode whitespace from both ends, as Python does (SQL ``trim`` only takes blanks)."""
    return F.btrim(col, F.lit(WHITESPACE))


def build_user_text(instruction: Column, input_text: Column) -> Column:
    """The instruction, followed by the headed input when one is left after stripping."""
    asked = py_strip(null_to_empty(instruction))
    given = py_strip(null_to_empty(input_text))
    return F.when(given == "", asked).otherwise(F.concat(asked, F.lit(INPUT_HEADING), given))
