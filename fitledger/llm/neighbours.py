"""Approximate nearest neighbours: windows of several shifted Hilbert orderings, merged and reranked."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from fitledger.llm.sampling import hash63, threshold
from fitledger.session import saved_table

# The number of curves and the share of all vectors in a window are those of least work, their product,
# for which a sample's recall reaches the target.
CURVES, DIMENSIONS, BITS = (2, 3, 4, 6, 8, 12), 8, 6
TARGET_RECALL = 0.93
SHARES = (0.001, 0.002, 0.005, 0.01, 0.02, 0.04, 0.06, 0.08, 0.1, 0.12, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6,
          0.65, 0.7, 0.75, 0.8, 0.9, 1.0)
# Vectors that the index is fitted on; it is a bound for the driver, and every vector is indexed.
SAMPLE_ROWS, SAMPLE_QUERIES = 4_000, 250
MAX_BLOCK = 4_096


@dataclass
class Index:
    """Projections with their ranges and shifts, one for each curve, and a window's share of all vectors."""

    size: int
    planes: np.ndarray      # curves, size, dimensions
    low: np.ndarray         # curves, dimensions
    span: np.ndarray
    shift: np.ndarray
    share: float = 1.0
    recall: float = 1.0

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """Hilbert keys (curves, n) of vectors."""
        cells = 1 << BITS
        out = np.empty((len(self.planes), len(vectors)), np.int64)
        for c, plane in enumerate(self.planes):
            place = (vectors @ plane - self.low[c] + self.shift[c] * self.span[c]) / (2 * self.span[c])
            out[c] = hilbert(np.clip((place * cells).astype(np.int64), 0, cells - 1))
        return out


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of integer coordinates below 2**bits.

    The coordinates are turned into the curve's bits one level at a time: at each level an axis whose bit is set
    inverts the lower bits of the first axis, any other swaps them with it; then a Gray code is undone.
    """
    axes = [a.copy() for a in np.asarray(cells, np.int64).T]
    level = 1 << (bits - 1)
    while level > 1:
        lower = level - 1
        for k, axis in enumerate(axes):
            inverted = (axis & level) != 0
            swap = np.where(inverted, 0, (axes[0] ^ axis) & lower)
            axes[0] = axes[0] ^ np.where(inverted, lower, swap)
            axes[k] = axes[0] if k == 0 else axis ^ swap
        level >>= 1
    for k in range(1, len(axes)):
        axes[k] = axes[k] ^ axes[k - 1]
    flips, level = np.zeros_like(axes[0]), 1 << (bits - 1)
    while level > 1:
        flips ^= np.where((axes[-1] & level) != 0, level - 1, 0)
        level >>= 1
    key = np.zeros_like(axes[0])
    for b in reversed(range(bits)):
        for axis in axes:
            key = key << 1 | ((axis ^ flips) >> b & 1)
    return key


def exact_scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in the order of the components whatever the batch."""
    total = np.zeros(len(left))
    for k in range(left.shape[1]):
        total += left[:, k] * right[:, k]
    return total


def top(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and exact scores of the k best vectors for each query, ties to the smaller id."""
    out = []
    for first in range(0, len(queries), 256):
        part = queries[first:first + 256]
        rough = part @ vectors.T
        for q, scores in zip(part, rough):
            at = np.arange(len(scores))
            if len(scores) > k:
                least = np.partition(scores, len(scores) - k)[len(scores) - k]
                at = np.flatnonzero(scores >= least - 1e-9 * (1 + abs(least)))
            exact = exact_scores(np.broadcast_to(q, (len(at), len(q))), vectors[at])
            order = np.lexsort((ids[at], -exact))[:k]
            out.append((at[order], exact[order]))
    return out


def fit_index(sample: np.ndarray, k: int = 20, target: float = TARGET_RECALL, choices: tuple[int, ...] = CURVES,
              dimensions: int = DIMENSIONS, seed: int = 0) -> Index:
    """Seeded projections, ranges from a sample, and of the ``choices`` of curves that whose windows reach the
    ``target`` recall on it with the least work: curves times the share of all vectors in a window.

    Neighbours in a sample are farther than among all vectors, so the recall on all is no lower as a rule. Clustered vectors
    get many curves with small windows; for vectors without structure a few curves with large windows are cheaper.
    """
    curves = max(choices)
    rng, size = np.random.default_rng(seed), sample.shape[1]
    dimensions = min(dimensions, size)
    planes = np.stack([np.linalg.qr(rng.standard_normal((size, size)))[0][:, :dimensions] for _ in range(curves)])
    low, high = (np.stack([np.quantile(sample @ p, q, axis=0) for p in planes]) for q in (0.01, 0.99))
    span = np.maximum(high - low, 1e-12)
    index = Index(size, planes, low, span, rng.random((curves, dimensions)))
    if len(sample) < 2:
        return index
    queries = np.arange(min(SAMPLE_QUERIES, len(sample)))
    scores = sample[queries] @ sample.T
    scores[queries, queries] = -np.inf
    k = min(k, len(sample) - 1)
    near = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    order = np.argsort(index.keys(sample), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(len(sample))[None], axis=1)
    gaps = np.abs(place[:, near] - place[:, queries][:, :, None])
    found = []
    for n in choices:
        gap = gaps[:n].min(axis=0)
        recalls = ((share, float((gap <= share * len(sample) / 2).mean())) for share in SHARES)
        found.append(next((n * share, n, share, recall) for share, recall in recalls if recall >= target or share == SHARES[-1]))
    _, n, share, recall = min(found)
    return Index(size, planes[:n], low[:n], span[:n], index.shift[:n], share, recall)


def usable(vector: str) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, not zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(embeddings: DataFrame, every: int = 20, k: int = 20, id_column: str = "vec_id",
            vector_column: str = "embedding", **options) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row whose id is divisible by ``every``.

    Nearness is the largest inner product in double precision, ties to the smaller id. Equal vectors are
    indexed once, with their k + 1 least ids, so a vector that a third of the rows share is one row. Each
    vector goes onto several shifted Hilbert curves; ranges of a curve are numbered in parallel and cut into
    blocks of bounded size. A query visits the blocks around its own, there the best are found in a dense
    product, and what all curves find is merged and ranked by exact scores.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do null ids; shorter vectors
    count as padded with zeros. With k candidates or fewer all are returned. Rows that repeat an id and
    a vector count once; an empty table gives no rows.
    """
    spark = embeddings.sparkSession
    kind = embeddings.schema[vector_column].dataType.elementType
    rows = embeddings.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vec")).where(
        usable("vec") & F.col("id").isNotNull())
    if not isinstance(kind, T.FloatType):
        rows = rows.withColumn("vec", F.col("vec").cast("array<double>"))
    classes = saved_table(
        rows.groupBy("vec").agg(F.min("id").alias("class"), F.max((F.col("id") % every == 0)).alias("asks"),
                                F.min("id").alias("low"), F.max("id").alias("high"))
        # A repeated id with different vectors keeps both: the class is told by a number of its own.
        .withColumn("key", F.xxhash64("vec", "class")), "vector-classes")
    stats = classes.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    n, size = stats[0], stats[1] or 1
    drawn = classes.where(hash63(F.xxhash64("key")) <= threshold(SAMPLE_ROWS, n)).orderBy("key").select("vec")
    sample = np.zeros((0, size))
    held = [r.vec for r in drawn.collect()] if n else []
    if held:
        sample = np.zeros((len(held), size))
        for row, vec in zip(sample, held):
            row[:len(vec)] = vec
    else:
        sample = np.zeros((1, size))
    index = fit_index(sample, k, **options)

    width = max(1, int(np.ceil(index.share * n / 2)))                  # of a window, to each side
    block = max(64, min(MAX_BLOCK, -(-width // 2)))
    reach = -(-width // block)
    placed = _placed(classes, index)
    base = _offsets(placed)
    starts = spark.createDataFrame(base, "part long, curve int, first long, base long")
    placed = placed.join(F.broadcast(starts), ["part", "curve"]).withColumn(
        "block", F.floor((F.col("at") - F.col("first") + F.col("base")) / block))
    last = max(0, (n - 1) // block)
    visits = placed.where("asks").withColumn("block", F.explode(F.sequence(
        F.greatest(F.col("block") - reach, F.lit(0)), F.least(F.col("block") + reach, F.lit(last)))))
    cells = placed.select("curve", "block", "key", "class", "body", F.lit(False).alias("query")).unionByName(
        visits.select("curve", "block", "key", "class", "body", F.lit(True).alias("query")))

    def search(group: pd.DataFrame) -> pd.DataFrame:
        matrix = np.frombuffer(b"".join(group.body), np.float64).reshape(len(group), -1)
        asks = group["query"].to_numpy()
        vectors, keys, ids = matrix[~asks], group.key.to_numpy()[~asks], group["class"].to_numpy()[~asks]
        if not len(vectors) or not asks.any():
            return pd.DataFrame({"query": [], "key": [], "class": [], "score": []})
        found = top(matrix[asks], vectors, ids, k + 1)
        at = np.concatenate([a for a, _ in found])
        return pd.DataFrame({
            "query": np.repeat(group.key.to_numpy()[asks], [len(a) for a, _ in found]), "key": keys[at],
            "class": ids[at], "score": np.concatenate([s for _, s in found])})

    found = cells.groupBy("curve", "block").applyInPandas(search, "query long, key long, class long, score double")
    merged = found.groupBy("query", "key", "class").agg(F.max("score").alias("score"))
    best = _ranked(merged, "query", ["class", "key"], k + 1).drop("place")
    # Classes of several ids: their k + 1 least ids; others have one.
    several = rows.join(classes.where("low < high").select("vec", "key"), "vec").select("key", "id").distinct()
    several = (several.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy("id")))
               .where(F.col("place") <= k + 1).select("key", "id"))
    listed = best.join(several, "key", "left").select("query", "score", F.coalesce("id", "class").alias("vec_id"))
    listed = _ranked(listed, "query", ["vec_id"], k + 1).drop("place")
    asking = rows.where(F.col("id") % every == 0).join(
        classes.where("asks").select("vec", "key"), "vec").select(F.col("id").alias("query_id"), F.col("key").alias("query")).distinct()
    answers = asking.join(listed, "query").where("query_id <> vec_id").select("query_id", "vec_id", "score")
    return _ranked(answers, "query_id", ["vec_id"], k).select(
        "query_id", F.col("place").alias("rank"), "vec_id", "score")


def _ranked(df: DataFrame, group: str, ties: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(group).orderBy(F.desc("score"), *ties)
    return df.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _placed(classes: DataFrame, index: Index) -> DataFrame:
    """Every vector on every curve, in ranges of the curves' order, with its place in its range."""
    shared = classes.sparkSession.sparkContext.broadcast(index)     # projections: curves * size * dimensions numbers

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                part = batch.slice(first, 2048)
                matrix = np.zeros((part.num_rows, index.size))
                for row, vec in zip(matrix, part.column("vec")):
                    row[:len(vec)] = vec.values.to_numpy()
                body = pa.array([row.tobytes() for row in matrix], pa.binary())
                for curve, place in enumerate(index.keys(matrix)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(matrix), curve, np.int32)), pa.array(place), part.column("key"),
                         part.column("class"), part.column("asks"), body],
                        ["curve", "place", "key", "class", "asks", "body"])

    ranged = (classes.select("vec", "key", "class", "asks")
              .mapInArrow(keyed, "curve int, place long, key long, class long, asks boolean, body binary")
              .repartitionByRange("curve", "place", "key").sortWithinPartitions("curve", "place", "key"))
    return saved_table(ranged.withColumn("at", F.monotonically_increasing_id())
                       .withColumn("part", F.shiftright("at", 33)), "vector-curves")


def _offsets(placed: DataFrame) -> list[tuple[int, int, int, int]]:
    """(part, curve, first place, vectors of the curve before it): a row or two for each range."""
    counted = placed.groupBy("part", "curve").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).collect()
    done: dict[int, int] = {}
    out = []
    for r in sorted(counted, key=lambda r: (r["part"], r["first"])):
        out.append((r["part"], r["curve"], r["first"], done.get(r["curve"], 0)))
        done[r["curve"]] = done.get(r["curve"], 0) + r["n"]
    return out
