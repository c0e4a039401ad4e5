"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fitledger.llm.sampling import HASH_SPAN, hash63, threshold
from fitledger.llm.words import LOWERED, chained, is_space, mix, runs, slices, spans_hash, text_bytes

BITS = 18
# At most about this many labelled documents are fitted on: a seeded sample, bounded for the driver's memory.
MAX_TRAINING_ROWS = 5_000
THRESHOLD = 0.7
# Each group of n-grams has the same total value in a document, so long and short texts weigh alike.
VALUE = 8.0
SPACE, WORD, MARK, BREAK = 0, 1, 2, 3


def _classes() -> np.ndarray:
    table = np.full(256, MARK, np.uint8)
    table[is_space()] = SPACE
    table[0x30:0x3A] = table[0x41:0x5B] = table[0x61:0x7B] = table[0x80:] = WORD
    table[0x0A] = BREAK
    return table


CLASSES = _classes()


def ngrams(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hashed n-grams of a batch, one group after the other: (slots, owning texts, value of a slot in each text).

    Tokens are runs of letters and digits, runs of marks, and line breaks. There are two streams of
    n-grams: one and two lower-cased tokens, and one to three token forms (capitals, length, digits, the marks
    themselves, and whether a token repeats the one or two before). Every text also has one slot of its own for
    the bias, so empty and null texts have a score, too.
    """
    data, offsets = text_bytes(column)
    n_rows = len(offsets) - 1
    kind = CLASSES[data]
    edges = np.flatnonzero(kind[1:] != kind[:-1]) + 1 if len(kind) else np.zeros(0, np.int64)
    at = np.unique(np.concatenate([edges, offsets[offsets < len(data)]])).astype(np.int64)
    ends = np.append(at[1:], len(data))
    keep = kind[at] != SPACE if len(at) else np.zeros(0, bool)
    starts, ends = at[keep], ends[keep]
    firsts = np.searchsorted(starts, offsets)
    token = spans_hash(LOWERED[data], starts, ends)
    upper = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    digit = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57))])
    length = ends - starts
    n_upper, n_digit = upper[ends] - upper[starts], digit[ends] - digit[starts]
    first_upper = upper[starts + 1] - upper[starts] if len(starts) else n_upper
    form = np.where(n_digit > 0, 4, np.where(n_upper == 0, 0, np.where(
        (n_upper == length) & (length > 1), 2, np.where((n_upper == 1) & (first_upper == 1), 1, 3))))
    form = form * 8 + np.digitize(length, (2, 4, 7, 12, 24))
    n_tokens = np.diff(firsts)
    owner = np.repeat(np.arange(n_rows), n_tokens)
    repeats = np.zeros(len(token), np.int64)
    for back in (1, 2):
        repeats[back:] += back * ((token[back:] == token[:-back]) & (owner[back:] == owner[:-back]))
    word = (kind[starts] == WORD) if len(starts) else np.zeros(0, bool)
    shape = np.where(word, mix((form * 4 + repeats).astype(np.uint64)), token ^ repeats.astype(np.uint64))

    yield np.zeros(n_rows, np.int64), np.arange(n_rows), np.ones(n_rows)
    for salt, (stream, n) in enumerate(((token, 1), (token, 2), (shape, 1), (shape, 2), (shape, 3)), 1):
        hashes = mix(chained(stream, n) + np.uint64(salt))
        whole = owner[:len(hashes)] == owner[n - 1:] if len(hashes) else np.zeros(0, bool)
        # Slot 0 is the bias.
        slots = np.maximum(hashes[whole] >> np.uint64(64 - BITS), np.uint64(1)).astype(np.int64)
        yield slots, owner[:len(hashes)][whole], VALUE / np.maximum(n_tokens - n + 1, 1)


def dot_products(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """The sparse dot product of each text of a batch with the weights."""
    z = np.zeros(len(column))
    for slots, owner, value in ngrams(column):
        z += value * np.bincount(owner, weights[slots], len(column))
    return z


def features(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Slots, each once, and their summed values for each text of a batch."""
    groups = [(slots, owner, value[owner]) for slots, owner, value in ngrams(column)]
    slots, owner, values = (np.concatenate(x) for x in zip(*groups))
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(1, len(column)))
    each = []
    for at, value in zip(np.split(slots[order], cuts), np.split(values[order], cuts)):
        known, back = np.unique(at, return_inverse=True)
        each.append((known.astype(np.int32), np.bincount(back, value, len(known)).astype(np.float32)))
    return each


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 4, alpha: float = 0.3,
             beta: float = 0.5, l1: float = 1e-3, l2: float = 1e-3, seed: int = 0) -> np.ndarray:
    """Weights by per-coordinate FTRL-proximal updates, one document at a time, in seeded order."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    order = np.random.default_rng(seed)
    share = np.clip(np.mean(labels), 0.02, 0.98) if len(labels) else 0.5
    balance = {0: 0.5 / (1 - share), 1: 0.5 / share}

    def weights(at):
        return np.where(np.abs(z[at]) <= l1, 0.0,
                        -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, value = rows[i]
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ value, -30, 30)))
            g = (p - labels[i]) * balance[int(labels[i])] * value
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(1 << BITS)).astype(np.float32)


def training_rows(documents: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING_ROWS,
                  folds: int = 4, held_out_fold: int = 2, usual_bytes: int = 1 << 14) -> DataFrame:
    """(quality, slots, values) of a seeded sample of about ``limit`` labelled documents outside the held-out fold.

    Documents labelled both ways, null labels and null ids are left out. Of documents that repeat an id one is used, the
    one with the least hash of its text. Texts beyond ``usual_bytes`` are drawn the less often the longer they are, so that the
    sample's bytes are bounded like its rows.
    """
    known = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()
                          & (F.crc32(F.col("doc_id").cast("string")) % folds != held_out_fold))
             .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
             .where("quality = other").select("doc_id", "quality"))
    known = known.where(hash63(F.xxhash64("doc_id")) <= threshold(limit, known.count()))
    # Bounded by ``limit``, so it goes to every executor and no text is shuffled.
    found = documents.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(known), "doc_id")
    rare = F.lit(usual_bytes) / F.greatest(F.lit(usual_bytes), F.octet_length("text"))
    found = found.where(hash63(F.xxhash64("doc_id", F.lit(1))) <= (rare * F.lit(float(HASH_SPAN - 1024))).cast("long"))
    chosen = found.groupBy("doc_id").agg(
        F.min_by(F.struct("text", "quality"), F.xxhash64("text")).alias("row")).select("row.text", "row.quality")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                each = features(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("quality"), pa.array([s.tobytes() for s, _ in each], pa.binary()),
                     pa.array([v.tobytes() for _, v in each], pa.binary())], ["quality", "slots", "values"])

    return chosen.mapInArrow(hashed, "quality int, slots binary, values binary")


def fit_quality(documents: DataFrame, labels: DataFrame, **options) -> np.ndarray:
    """Weights fitted on :func:`training_rows`; all zero (score one half) without labelled rows."""
    found = training_rows(documents, labels, **options).toArrow()
    rows = sorted(zip(found.column("slots").to_pylist(), found.column("values").to_pylist(),
                      found.column("quality").to_pylist()))      # the same order in every run
    return fit_ftrl([(np.frombuffer(s, np.int32), np.frombuffer(v, np.float32)) for s, v, _ in rows],
                    np.array([y for _, _, y in rows], float))


def score_quality(documents: DataFrame, weights: np.ndarray, columns: list[str] | None = None,
                  text_column: str = "text", keep_text: bool = False) -> DataFrame:
    """``columns`` (default: doc_id) and ``score`` in [0, 1] for each document: higher is likelier good.

    With ``keep_text`` the text is returned as well; it goes through Python once either way.

    Whole texts are scored as sparse dot products; empty and null texts by the bias alone. Repeated rows
    stay repeated, and an empty table gives no rows.
    """
    columns = columns or ["doc_id"]
    shared = documents.sparkSession.sparkContext.broadcast(weights)     # 2^BITS numbers, whatever the input
    rows = documents.select(F.struct(*columns).alias("_row"), F.col(text_column).alias("_text"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                z = dot_products(part.column("_text"), shared.value)
                score = pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), score], [*carried, "score"])

    carried = ["_row", "_text"] if keep_text else ["_row"]
    schema = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in carried) + "score double"
    text = [F.col("_text").alias(text_column)] if keep_text else []
    return rows.mapInArrow(scored, schema).select("_row.*", *text, "score")
