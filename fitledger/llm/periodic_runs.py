"""Periodic runs of words: minimizers of several scales seed long periods, lag scans find short ones.

A run is a stretch of words with smallest period q and at least ``max(12, 2 * q)`` words that no neighbouring
word extends. Texts of a slice stand one after the other, each closed by a separator that equals nothing.

*Short periods*, below ``2 * SHORTEST - 1``, are found by comparing the words with themselves at each lag.

*Long periods*: the scale k (16, 32, 64, ..) serves the periods from ``2k - 1`` to ``4k - 2``. The least hash of k
neighbouring k-grams is selected. Such a window lies within the first period of a run and repeats one period later, so both
select equal k-grams at a distance of the period. Every such pair is extended by comparing words.
K-grams with a period of k/2 or less come last in the choice; the others are over k/2 words apart, so each has
fewer than eight partners within 4k words. If a window has no other k-grams, the whole first period has
one period p of at most k/2 (Fine and Wilf), and the run spans two neighbouring runs of that p: its
possible periods are those by which the second run continues the first in step, and they are listed from the two runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fitledger.llm.words import mix, slices

SHORTEST = 16
LEAST_WORDS = 12
PARTNERS = 8
RUNS = "array<struct<start:long,length:long,period:long>>"


def _stretches(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of consecutive numbers in a sorted array."""
    if not len(at):
        return at, at
    cut = np.flatnonzero(np.diff(at) > 1)
    return at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])] + 1


def _lag_scan(ids: np.ndarray, lag: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches with this period."""
    starts, ends = _stretches(np.flatnonzero(ids[lag:] == ids[:-lag]))
    ends = ends + lag
    keep = ends - starts >= max(LEAST_WORDS, 2 * lag)
    return starts[keep], ends[keep]


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many words two sequences share from their start."""
    n, done, step = min(len(a), len(b)), 0, 64
    while done < n:
        differ = a[done:min(done + step, n)] != b[done:min(done + step, n)]
        if differ.any():
            return done + int(differ.argmax())
        done, step = done + step, 2 * step
    return n


def _extended(ids: np.ndarray, low: int, high: int, lag: int) -> tuple[int, int]:
    """Grow [low, high), where words equal those one lag later, as far as they do."""
    high += _agreeing(ids[high:], ids[high + lag:])
    low -= _agreeing(ids[:low][::-1], ids[:low + lag][::-1])
    return low, high


def _minimizers(values: np.ndarray, width: int) -> np.ndarray:
    """Places that are the leftmost least value of some ``width`` neighbours; the width is a power of two."""
    least, place, span = values, np.arange(len(values)), 1
    while span < width:
        later = least[span:] < least[:-span]
        least = np.where(later, least[span:], least[:-span])
        place = np.where(later, place[span:], place[:-span])
        span *= 2
    return np.unique(place)


def _pairs(grams: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """(lag, place) of all equal k-grams whose distance this scale serves, sorted."""
    order = np.lexsort((places, grams))
    grams, places = grams[order], places[order]
    found = [np.zeros((0, 2), np.int64)]
    for j in range(1, PARTNERS + 1):
        lag = places[j:] - places[:-j]
        good = (grams[j:] == grams[:-j]) & (lag >= 2 * k - 1) & (lag <= 4 * k - 2)
        found.append(np.stack([lag[good], places[:-j][good]], axis=1))
    pairs = np.concatenate(found)
    return pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]


def _seeded(ids: np.ndarray, pairs: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(start, end, lag) of the stretches around the pairs, each stretch once."""
    last_lag, done = 0, 0
    for lag, place in pairs.tolist():
        if lag == last_lag and place < done:
            continue
        low, high = _extended(ids, place, place, lag)
        last_lag, done = lag, high
        if high - low >= lag:
            yield low, high + lag, lag


def _turn(first: np.ndarray, second: np.ndarray) -> int | None:
    """By how many words a period is turned to give the other, if it is."""
    twice, wanted, at = np.concatenate([first, first]).tobytes(), second.tobytes(), -1
    while (at := twice.find(wanted, at + 1)) >= 0:
        if at % first.itemsize == 0:
            return at // first.itemsize
    return None


def _spanning(ids: np.ndarray, runs: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, lag) of stretches whose period continues one run of a short period in the next in step."""
    runs = runs[runs[:, 2] <= k // 2]
    runs = runs[np.lexsort((runs[:, 0], runs[:, 2]))]
    one, two = runs[:-1], runs[1:]
    meet = ((one[:, 2] == two[:, 2]) & (two[:, 0] <= one[:, 1])
            & (np.minimum(one[:, 1] - one[:, 0], two[:, 1] - two[:, 0]) >= 2 * k - 1))
    for (s1, e1, p), (s2, e2, _) in zip(one[meet].tolist(), two[meet].tolist()):
        turned = _turn(ids[s1:s1 + p], ids[s2:s2 + p])
        if turned is None:
            continue
        first = 2 * k - 1
        first += (s2 - s1 - turned - first) % p
        for lag in range(first, min(4 * k - 2, e1 - s1, e2 - s2) + 1, p):
            low, high = max(s1, s2 - lag), min(e1, e2 - lag)
            if high - low < lag:
                continue
            # Where both runs end at once the words behind them may agree again.
            if e1 == e2 - lag:
                high = _extended(ids, high, high, lag)[1]
            if s1 == s2 - lag:
                low = _extended(ids, low, low, lag)[0]
            yield low, high + lag, lag


def find_runs(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All runs, as rows (start, end, period) sorted by start and period.

    ``ids`` are the word numbers of texts of these lengths, each text followed by a number that occurs once.
    """
    found = [np.zeros((0, 3), np.int64)]
    longest = int(lengths.max(initial=0))
    for lag in range(1, min(2 * SHORTEST - 1, longest // 2 + 1)):
        starts, ends = _lag_scan(ids, lag)
        found.append(np.stack([starts, ends, np.full(len(starts), lag)], axis=1))
    runs = _primitive(np.concatenate(found))
    places = np.arange(len(ids))
    owner = np.repeat(np.arange(len(lengths)), lengths + 1)
    grams, k = mix(ids.astype(np.uint64) + np.uint64(1)), 1
    while 4 * max(k, SHORTEST) - 2 <= longest:
        while True:
            grams = mix(grams[:len(grams) - k] * np.uint64(0x9E3779B97F4A7C15) + grams[k:])
            k *= 2
            if k >= SHORTEST:
                break
        # Only texts that have room for two of the periods go on to this scale and the next.
        room = lengths[owner[:len(places)]] >= 4 * k - 2
        grams, places, owner = grams[room[:len(grams)]], places[room], owner[:len(room)][room]
        covered = np.zeros(len(ids) + 1, np.int64)
        inside = runs[(runs[:, 2] <= k // 2) & (runs[:, 1] - runs[:, 0] >= k)]
        np.add.at(covered, inside[:, 0], 1)
        np.add.at(covered, inside[:, 1] - k + 1, -1)
        periodic = np.cumsum(covered)[places[:len(grams)]] > 0
        ranked = (grams >> np.uint64(1)) | (periodic.astype(np.uint64) << np.uint64(63))
        if len(ranked) >= k:
            chosen = _minimizers(ranked, k)
            chosen = chosen[~periodic[chosen]]
            more = list(_seeded(ids, _pairs(grams[chosen], places[chosen], k)))
            more += _spanning(ids, runs, k)
            if more:
                runs = _primitive(np.concatenate([runs, np.array(more, np.int64)]))
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _primitive(runs: np.ndarray) -> np.ndarray:
    """Each stretch once, with its smallest period: a multiple of that gives the same stretch."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[new]


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts, a separator after each text, and the texts' lengths."""
    lengths = np.array([len(t) for t in texts], np.int64)
    numbers = {word: n for n, word in enumerate(dict.fromkeys(chain.from_iterable(texts)))}
    ids = np.empty(int(lengths.sum()) + len(texts), np.int64)
    ends = np.cumsum(lengths + 1) - 1
    member = np.ones(len(ids), bool)
    member[ends] = False
    ids[member] = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts)), np.int64, int(lengths.sum()))
    ids[ends] = len(numbers) + np.arange(len(texts))
    return ids, lengths


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            column = part.column("text").fill_null("")
            texts = [t.split() for t in column.cast(pa.binary()).to_pylist()]
            ids, lengths = _numbered(texts)
            runs = find_runs(ids, lengths)
            firsts = np.concatenate([[0], np.cumsum(lengths + 1)])
            owner = np.searchsorted(firsts, runs[:, 0], side="right") - 1
            steps = np.zeros(len(ids) + 1, np.int64)
            np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
            np.add.at(steps, runs[:, 1], -1)
            kept = np.cumsum(steps)[:-1] == 0
            repeated = np.bincount(owner, minlength=len(texts))
            out = [b" ".join(compress(words, kept[first:first + len(words)].tolist()) if n else words)
                   for words, first, n in zip(texts, firsts.tolist(), repeated.tolist())]
            listed = pa.StructArray.from_arrays(
                [pa.array(runs[:, 0] - firsts[owner]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])],
                ["start", "length", "period"])
            offsets = pa.array(np.concatenate([[0], np.cumsum(repeated)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(lengths), pa.ListArray.from_arrays(offsets, listed),
                 pa.array(out, pa.binary()).view(pa.string())],
                ["id", "n_words", "runs", "collapsed"])


def periodic_runs(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row (id, n_words, runs, collapsed) for each document.

    Words are runs of anything but white space (0x20, 0x09 to 0x0D), numbered from 0. ``runs`` holds all runs as
    (start, length, period) by start, then period; ``collapsed`` is the words, joined by one space, without those
    that some run contains after its first period.

    Every document is on its own: no shuffle, and whole texts, one slice of some 0.5 MB (one text at least) at a time.
    A null or empty text, or one of white space, has no words, no runs and an empty ``collapsed``. A text of one
    word over and over is one run of period 1. Null ids and repeated rows stay as they are, each with its own
    result; other columns are ignored; an empty table gives no rows.
    """
    kind = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return (rows.mapInArrow(_collapse, f"id {kind}, n_words long, runs {RUNS}, collapsed string")
            .withColumnRenamed("id", id_column))
