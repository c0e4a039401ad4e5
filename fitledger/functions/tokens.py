"""Whitespace tokens: split, cut to length, join."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fitledger.functions.text import WHITESPACE, WHITESPACE_RANGES

# Fixed value: the longest example, in tokens, that is kept uncut.
MAX_LENGTH = 2048

# One or more whitespace characters. Java looks single Latin-1 characters up in a
# bit set, and the intersection turns other letters away with one comparison, which
# makes this several times faster than the plain list of ranges.
_LATIN = "".join(rf"\x{{{ord(c):X}}}" for c in WHITESPACE if c <= "\xff")
_WIDE = [r for r in WHITESPACE_RANGES if r[0] > 0xFF]
_WIDE_LIST = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in _WIDE)
TOKEN_BREAK = rf"[{_LATIN}[\x{{{_WIDE[0][0]:X}}}-\x{{{_WIDE[-1][1]:X}}}&&[{_WIDE_LIST}]]]+"


def tokenize(text: Column) -> Column:
    """Split on runs of Unicode whitespace; no empty tokens."""
    return F.array_remove(F.split(text, TOKEN_BREAK), "")


def truncate_tokens(tokens: Column, max_length: int = MAX_LENGTH) -> Column:
    """Keep the first ``max_length`` tokens."""
    return F.slice(tokens, 1, max_length)


def is_truncated(tokens: Column, max_length: int = MAX_LENGTH) -> Column:
    return F.size(tokens) > max_length


def decode_tokens(tokens: Column) -> Column:
    """Tokens back to text, one blank between them."""
    return F.array_join(tokens, " ")
