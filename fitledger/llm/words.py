"""Words of whole Arrow batches of texts as numpy arrays: starts, ends, hashes and owning rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1


def lowered_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWERED = lowered_table()


def is_space() -> np.ndarray:
    """Bytes that are white space: 0x20 and 0x09 to 0x0D."""
    table = np.zeros(256, dtype=bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def is_alphanumeric() -> np.ndarray:
    """Bytes of words made of digits, a-z (after lower-casing) and everything beyond ASCII."""
    table = np.zeros(256, dtype=bool)
    table[0x30:0x3A] = table[0x61:0x7B] = table[0x80:] = True
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a batch of texts and the offsets of the rows; null is the empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def runs(flags: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags; a run also ends at each cut."""
    edge = np.empty(len(flags) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(flags[1:], flags[:-1], out=edge[1:-1])
    edge[cuts] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    keep = flags[starts]
    return starts[keep], ends[keep]


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """The multiplier's powers and those of its inverse, at least ``n`` of each, kept for the next batch."""
    if len(_POWERS[0]) < n:
        size = max(n, 2 * len(_POWERS[0]))
        for k, base in enumerate((_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each span of bytes: a polynomial from prefix sums, scrambled."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers, inverse = _powers(len(data))
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:len(data)], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * inverse[starts])


def words(column: pa.Array, member: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lower-cased words of a batch: (bytes, starts, ends, hashes, first word of each row and one past the last)."""
    data, offsets = text_bytes(column)
    data = LOWERED[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return data, none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    starts, ends = runs(member[data], offsets[offsets < len(data)])
    return data, starts, ends, spans_hash(data, starts, ends), np.searchsorted(starts, offsets)


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all sequences of ``n`` neighbouring words (also those that cross rows)."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    last = len(hashes) - n + 1
    value = hashes[:last].copy()
    for k in range(1, n):
        value = mix(value * np.uint64(_MULTIPLIER) + hashes[k:k + last])
    return value


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 19):
    """Cut a batch into parts of some ``limit`` bytes of text, one row at least, to bound memory."""
    lengths = np.array([0 if n is None else n for n in _lengths(batch.column(column))], np.int64)
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if size and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def _lengths(column: pa.Array) -> list:
    import pyarrow.compute as pc

    return pc.binary_length(column).to_pylist()
