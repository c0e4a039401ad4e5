"""Benchmark decontamination: Wu-Manber search for windows of benchmark words in documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from fitledger.llm.words import chained, is_alphanumeric, slices, words
from fitledger.session import saved_table

WINDOW = 10
# Benchmark text searched for in one pass; its tables are a few times this size in every Python worker.
PART_BYTES = 16 << 20
TABLE_BITS = 20
HITS_SCHEMA = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


class Patterns:
    """All windows of one length: block shift table, suffix buckets and the windows' places in the items."""

    def __init__(self, length: int, hashes: np.ndarray, at: np.ndarray, item: np.ndarray):
        self.length, self.block = length, min(2, length)
        mask = np.uint64((1 << TABLE_BITS) - 1)
        blocks = chained(hashes, self.block)
        self.shift = np.full(1 << TABLE_BITS, length - self.block + 1, np.uint8)
        for k in range(length - self.block + 1):    # the block that begins k words into the window
            slot = blocks[at + k] & mask
            np.minimum.at(self.shift, slot, length - self.block - k)
        suffix, whole = blocks[at + length - self.block], chained(hashes, length)[at]
        order = np.lexsort((whole, suffix))
        self.suffix, self.whole, self.at, self.item = suffix[order], whole[order], at[order], item[order]

    def candidates(self, blocks: np.ndarray, firsts: np.ndarray) -> list[int]:
        """First words of the windows of the text whose last block may end a pattern."""
        jump = self.shift[blocks & np.uint64((1 << TABLE_BITS) - 1)].tolist()
        ahead, found = self.length - self.block, []
        for first, last in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
            at, end = first + ahead, last - self.block
            while at <= end:
                step = jump[at]
                if step:
                    at += step
                else:
                    found.append(at - ahead)
                    at += 1
        return found


class Search:
    """The windows of a part of the benchmark, ready to be looked for in batches of texts."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.ids = [i for i, _ in items]
        data, starts, ends, hashes, firsts = words(pa.array([t for _, t in items], pa.string()), is_alphanumeric())
        self.words = [data[s:e].tobytes() for s, e in zip(starts.tolist(), ends.tolist())]
        sizes = np.diff(firsts)
        self.scanners = []
        for length in sorted({min(int(n), window) for n in sizes if n}):
            chosen = np.flatnonzero(np.minimum(sizes, window) == length)
            counts = sizes[chosen] - length + 1
            item = np.repeat(chosen, counts)
            at = np.repeat(firsts[chosen], counts) + np.arange(counts.sum()) - np.repeat(counts.cumsum() - counts, counts)
            self.scanners.append(Patterns(length, hashes, at, item))

    def scan(self, column: pa.Array) -> list[tuple[int, list[tuple[int, int]], set[int]]]:
        """For each text: its number of words, spans of hit words (start, end) and items found."""
        data, starts, ends, hashes, firsts = words(column, is_alphanumeric())
        spans: list[list] = [[] for _ in range(len(column))]
        items: list[set] = [set() for _ in range(len(column))]
        for scanner in self.scanners:
            n = scanner.length
            # Blocks of the last words would run over the end: pad, the loop never reads them.
            blocks = np.concatenate([chained(hashes, scanner.block), np.zeros(scanner.block, np.uint64)])
            at = np.array(scanner.candidates(blocks, firsts), np.int64)
            if not len(at):
                continue
            suffix, whole = blocks[at + n - scanner.block], chained(hashes, n)[at]
            low = np.searchsorted(scanner.suffix, suffix, "left")
            high = np.searchsorted(scanner.suffix, suffix, "right")
            row = np.searchsorted(firsts, at, "right") - 1
            for k in np.flatnonzero(low < high).tolist():
                lo = low[k] + np.searchsorted(scanner.whole[low[k]:high[k]], whole[k], "left")
                hi = low[k] + np.searchsorted(scanner.whole[low[k]:high[k]], whole[k], "right")
                if lo == hi:
                    continue
                first = int(at[k])
                text = [data[starts[j]:ends[j]].tobytes() for j in range(first, first + n)]
                for p in range(lo, hi):
                    if text == self.words[scanner.at[p]:scanner.at[p] + n]:
                        items[row[k]].add(int(scanner.item[p]))
                        start = first - int(firsts[row[k]])
                        spans[row[k]].append((start, start + n))
        return [(int(n), merged(s), i) for n, s, i in zip(np.diff(firsts), spans, items)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def benchmark_hits(documents: DataFrame, benchmark: DataFrame, columns: list[str] | None = None,
                   text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text",
                   window: int = WINDOW, part_bytes: int = PART_BYTES, keep_text: bool = False) -> DataFrame:
    """``columns`` (default: doc_id) of each document with n_words, hits (word spans) and items found.

    With ``keep_text`` the text is returned as well.

    Words are runs of digits, a-z (A-Z lower-cased) and characters beyond ASCII. A window is ``window``
    neighbouring words of an item; an item with fewer, but not none, is one window. ``hits`` are the merged
    spans [start, end) of document words inside any occurrence; ``items`` the ids, as strings, in order.
    The search goes over word positions: block shift tables skip what can't end a window, suffix-hash
    buckets choose the windows to test, and comparing the words themselves confirms.

    The benchmark is searched for in parts of about ``part_bytes``, one pass over the documents for each, so
    its size isn't limited. Null or empty texts have no words and no hits; null item ids take no part; equal
    items count under each id; an empty benchmark hits nothing; repeated documents stay repeated.
    """
    spark = documents.sparkSession
    columns = columns or ["doc_id"]
    known = benchmark.select(F.col(item_column).cast("string").alias("item"), F.col(item_text_column).alias("body")
                             ).where("item is not null and body is not null").distinct()
    size = known.agg(F.coalesce(F.sum(F.octet_length("body") + 16), F.lit(0))).first()[0]
    n_parts = max(1, -(-size // part_bytes))
    # The caller's columns are carried in a struct, so that their names can't clash with these.
    state = documents.select(F.struct(*columns).alias("_row"), F.col(text_column).alias("_text"),
                             F.lit(0).cast("long").alias("n_words"),
                             F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("_hits"),
                             F.expr("cast(array() as array<string>)").alias("_items"))
    for part in range(n_parts):
        chosen = known if n_parts == 1 else known.where(
            F.pmod(F.xxhash64("item", "body"), F.lit(n_parts)) == part)
        shared = spark.sparkContext.broadcast([(r.item, r.body) for r in chosen.collect()])
        last = part + 1 == n_parts
        carried = [f for f in state.schema if f.name != "_text" or keep_text or not last]
        state = state.mapInArrow(_scanner(shared, window, [f.name for f in carried]), T.StructType(carried))
        if not last:
            state = saved_table(state, "benchmark-hits")
    text = [F.col("_text").alias(text_column)] if keep_text else []
    return state.select("_row.*", *text, "n_words", F.col("_hits").alias("hits"),
                        F.array_sort("_items").alias("items"))


def _scanner(shared, window: int, carried: list[str]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(shared.value, window)
        for batch in batches:
            for part in slices(batch, "_text"):
                found = search.scan(part.column("_text"))
                spans, items = [], []
                for (_, hits, ids), old, names in zip(
                        found, part.column("_hits").to_pylist(), part.column("_items").to_pylist()):
                    hits = merged(hits + [(h["start"], h["end"]) for h in old]) if old else hits
                    spans.append([{"start": s, "end": e} for s, e in hits])
                    items.append(sorted({*names, *(search.ids[i] for i in ids)}))
                fresh = {"n_words": pa.array([n for n, _, _ in found], pa.int64()),
                         "_hits": pa.array(spans, HITS_SCHEMA), "_items": pa.array(items, pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays(
                    [fresh.get(name, part.column(name)) for name in carried], carried)

    return scan


def contamination(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row (doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per document."""
    hits = benchmark_hits(documents, benchmark, ["doc_id"], **options)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["end"] - h["start"])
    return hits.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))
