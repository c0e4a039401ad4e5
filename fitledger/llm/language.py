"""Language identification: a bidirectional gated recurrent network over bytes, trained here in numpy."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fitledger.llm.sampling import drawn
from fitledger.llm.words import slices, text_bytes
from fitledger.operators.ordered import numbered

HIDDEN = 8
# A text is read in stretches of so many bytes, each from a fresh state; all stretches of all texts are read.
STRETCH = 128
PADDING = 256
# At most about so many documents of each language are fitted on: bounded for the driver.
MAX_TRAINING_ROWS = 600
# A network has so many languages at most: the most frequent.
MAX_LANGUAGES = 200
UNKNOWN = "und"
# The label of stretches in none of the languages; it is never predicted for a document.
OTHER = "\0other"
# Ranges of letters, by script, of which stretches in no learnt language are made.
SCRIPTS = [(0x391, 0x3C9), (0x410, 0x44F), (0x531, 0x587), (0x5D0, 0x5EA), (0x621, 0x64A), (0x905, 0x939), (0xE01, 0xE2E),
           (0x10D0, 0x10F0), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3)]


@dataclass
class Network:
    """Weights of both directions (first axis): input tables (257 symbols), recurrent and output weights."""

    languages: list[str]    # learnt ones, and OTHER at the end
    table: np.ndarray       # 2, 257, 3H: what each byte adds to update, reset and new-state gates
    recurrent: np.ndarray   # 2, H, 3H
    output: np.ndarray      # 2, H, L
    bias: np.ndarray        # L

    def learnt(self) -> list[str]:
        return [name for name in self.languages if name != OTHER]

    def parameters(self) -> list[np.ndarray]:
        return [self.table, self.recurrent, self.output, self.bias]


def fresh(languages: list[str], hidden: int = HIDDEN, seed: int = 0) -> Network:
    rng = np.random.default_rng(seed)
    return Network(
        languages, rng.normal(0, 0.3, (2, 257, 3 * hidden)).astype(np.float32),
        rng.normal(0, hidden ** -0.5, (2, hidden, 3 * hidden)).astype(np.float32),
        rng.normal(0, hidden ** -0.5, (2, hidden, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32))


def states(net: Network, symbols: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states (2, T, B, H) for symbols (T, B); the second direction reads from the end.

    Padded positions leave the state as it is. ``keep`` gets what back-propagation needs of each step.
    """
    steps, batch = symbols.shape
    hidden = net.recurrent.shape[1]
    out = np.empty((2, steps, batch, hidden), np.float32)
    h = np.zeros((2, batch, hidden), np.float32)
    added = np.empty((2, batch, 3 * hidden), np.float32)
    padded = (symbols == PADDING).any(axis=1)
    for t in range(steps):
        for way, at in enumerate((t, steps - 1 - t)):
            np.take(net.table[way], symbols[at], axis=0, out=added[way])
        recurrent = np.matmul(h, net.recurrent)
        gates = added[..., :2 * hidden] + recurrent[..., :2 * hidden]
        gates *= 0.5
        np.tanh(gates, out=gates)   # the logistic function by way of tanh
        gates *= 0.5
        gates += 0.5
        z, r = gates[..., :hidden], gates[..., hidden:]
        n = r * recurrent[..., 2 * hidden:]
        n += added[..., 2 * hidden:]
        np.tanh(n, out=n)
        new = h - n
        new *= z
        new += n
        mask = None
        if padded[t] or padded[steps - 1 - t]:
            mask = np.stack([symbols[t], symbols[steps - 1 - t]])[..., None] != PADDING
            new = np.where(mask, new, h)
        if keep is not None:
            keep.append((h, z, r, n, recurrent[..., 2 * hidden:], mask))
        h = new
        out[0, t], out[1, steps - 1 - t] = h[0], h[1]
    return out


def label_probabilities(net: Network, out: np.ndarray) -> np.ndarray:
    """Probabilities (T, B, L) of the languages at every position."""
    logits = out[0] @ net.output[0] + out[1] @ net.output[1] + net.bias
    logits -= logits.max(axis=-1, keepdims=True)
    np.exp(logits, out=logits)
    return logits / logits.sum(axis=-1, keepdims=True)


def gradients(net: Network, symbols: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over all positions and its gradients, by back-propagation through time."""
    keep: list = []
    out = states(net, symbols, keep)
    p = label_probabilities(net, out)
    steps, batch = symbols.shape
    hidden = net.recurrent.shape[1]
    real = (symbols != PADDING)
    total = max(1, int(real.sum()))
    chosen = np.take_along_axis(p, np.broadcast_to(labels, (steps, batch))[..., None], axis=2)[..., 0]
    loss = float(-(np.log(chosen + 1e-9) * real).sum() / total)
    d = p.copy()
    d[:, np.arange(batch), labels] -= 1
    d *= real[..., None] / total
    g_output = np.stack([np.tensordot(out[way], d, ((0, 1), (0, 1))) for way in (0, 1)])
    d_out = np.stack([d @ net.output[way].T for way in (0, 1)])
    g_table, g_recurrent = np.zeros_like(net.table), np.zeros_like(net.recurrent)
    back = np.ascontiguousarray(net.recurrent.transpose(0, 2, 1))
    dh = np.zeros((2, batch, hidden), np.float32)
    for t in reversed(range(steps)):
        h, z, r, n, inner, mask = keep[t]
        dh = dh + np.stack([d_out[0, t], d_out[1, steps - 1 - t]])
        passed = 0.0
        if mask is not None:
            passed, dh = np.where(mask, 0, dh), np.where(mask, dh, 0)
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * inner * r * (1 - r)
        d_in = np.concatenate([dz, dr, dn], axis=2)
        d_rec = np.concatenate([dz, dr, dn * r], axis=2)
        for way, at in enumerate((t, steps - 1 - t)):
            np.add.at(g_table[way], symbols[at], d_in[way])
        g_recurrent += np.matmul(h.transpose(0, 2, 1), d_rec)
        dh = dh * z + np.matmul(d_rec, back) + passed
    return loss, [g_table, g_recurrent, g_output, d.sum(axis=(0, 1))]


def unseen_scripts(texts: list[bytes]) -> list[tuple[int, int]]:
    """The scripts of which none of the texts has letters to speak of: more than one in a thousand characters."""
    letters = "".join(t.decode(errors="ignore") for t in texts)
    points = np.frombuffer(letters.encode("utf-32-le"), np.uint32)
    return [(low, high) for low, high in SCRIPTS if ((points >= low) & (points <= high)).sum() * 1000 <= len(points)]


def foreign_text(scripts: list[tuple[int, int]], rng: np.random.Generator, size: int) -> bytes:
    """Words of random letters of one script."""
    low, high = scripts[rng.integers(len(scripts))]
    letters = [chr(c) for c in rng.integers(low, high + 1, size)]
    gaps = rng.random(size) < 0.15
    return "".join(c + " " if gap else c for c, gap in zip(letters, gaps)).encode()


def train(texts: list[bytes], labels: list[str], steps: int = 400, batch: int = 208, length: int = 48,
          rate: float = 0.02, hidden: int = HIDDEN, seed: int = 0) -> Network | None:
    """A network fitted by Adam on random stretches of the texts, all languages alike; None without texts.

    One more label, OTHER, is learnt from stretches in scripts that the texts do not use.
    """
    pairs = sorted((t, l) for t, l in zip(texts, labels) if t)      # the same order in every run
    languages = sorted({l for _, l in pairs})
    if not languages:
        return None
    by = [[t for t, l in pairs if l == name] for name in languages]
    scripts = unseen_scripts([t for t, _ in pairs])
    net, rng = fresh([*languages, OTHER] if scripts else languages, hidden, seed), np.random.default_rng(seed)
    first = [np.zeros_like(w) for w in net.parameters()]
    second = [np.zeros_like(w) for w in net.parameters()]
    for step in range(1, steps + 1):
        truth = rng.integers(len(net.languages), size=batch)
        symbols = np.full((length, batch), PADDING)
        for k, name in enumerate(truth):
            text = by[name][rng.integers(len(by[name]))] if name < len(by) else foreign_text(scripts, rng, length)
            start = rng.integers(max(1, len(text) - length + 1))
            part = np.frombuffer(text[start:start + length], np.uint8)
            symbols[:len(part), k] = part
        _, slopes = gradients(net, symbols, truth)
        lr = rate * min(1, 2 - 2 * step / steps)
        for w, g, m, v in zip(net.parameters(), slopes, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= lr * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return net


def document_probabilities(net: Network, column: pa.Array) -> np.ndarray:
    """Mean of the label probabilities over all bytes of each text (rows, L); zero for empty texts."""
    data, offsets = text_bytes(column)
    sizes = np.diff(offsets)
    pieces = -(-sizes // STRETCH)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    order = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = offsets[owner] + order * STRETCH
    lengths = np.minimum(STRETCH, offsets[owner + 1] - starts)
    pooled = np.zeros((len(sizes), len(net.languages)))
    for k in range(0, len(owner), 4096):
        part = slice(k, k + 4096)
        at = np.arange(min(STRETCH, int(lengths[part].max())))[:, None]
        real = at < lengths[part]
        # Wider than a byte, so that the padding is a symbol of its own.
        symbols = np.where(real, data[np.minimum(starts[part] + at, len(data) - 1)].astype(np.int16), np.int16(PADDING))
        p = label_probabilities(net, states(net, symbols)) * real[..., None]
        np.add.at(pooled, owner[part], p.sum(axis=0))
    return pooled / np.maximum(sizes, 1)[:, None]


def fit_language(documents: DataFrame, limit: int = MAX_TRAINING_ROWS, max_bytes: int = 4096, folds: int = 3,
                 held_out_fold: int = 1, max_languages: int = MAX_LANGUAGES, **options) -> Network | None:
    """A network learnt from text and language of about ``limit`` documents per language outside the held-out fold.

    A training text gives its random stretches from ``max_bytes`` bytes at a hashed place of the whole text, which
    bounds what the driver holds; prediction reads whole texts. Documents are drawn by a hash of id and
    text, and equal ones are drawn once, so that neither a repeated id nor a repeated row fills the sample. Null ids, languages and
    texts are left out. A column of many languages gives the ``max_languages`` most frequent, ties by name.
    """
    crc = F.crc32(F.col("doc_id").cast("string"))
    known = documents.where((crc % folds != held_out_fold) & F.col("lang").isNotNull())
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    counts = counts.orderBy(F.desc("rows"), "lang").limit(max_languages)        # bounded, so it may be broadcast
    places = F.greatest(F.lit(1), F.octet_length("text") - F.lit(max_bytes - 1))
    start = (F.lit(1) + F.pmod(F.xxhash64("order", F.lit(1)), places)).cast("int")
    sample = (
        known.where(F.col("text").isNotNull()).select("lang", "text", F.xxhash64("doc_id", "text").alias("order"))
        .join(F.broadcast(counts), "lang").where(drawn(F.col("order"), limit, F.col("rows")))
        .select("lang", "order", F.substring(F.encode("text", "UTF-8"), start, F.lit(max_bytes)).alias("body"))
        .dropDuplicates(["lang", "order"]).select("lang", "body").toArrow()
    )
    return train(sample.column("body").to_pylist(), sample.column("lang").to_pylist(), **options)


def least_score(predicted: DataFrame, net: Network, folds: int = 3, held_out_fold: int = 1,
                quantile: float = 0.001) -> float:
    """The score that all but a ``quantile`` of rightly labelled documents reach.

    It is the score of exactly that rank among all documents (doc_id, lang, lang_pred, score) of the fold that the network
    has not seen; 0 if there are none. It moves with the number of languages and with how sure the network is, as a fixed
    score would not. The scores are numbered by ranges, so no task holds them all.
    """
    crc = F.crc32(F.col("doc_id").cast("string"))
    right = predicted.where(
        (crc % folds == held_out_fold) & F.col("lang").isin(net.learnt()) & (F.col("lang") == F.col("lang_pred")))
    places = numbered(right.select("score"), [F.asc("score")], "place", "language-scores")
    rank = math.ceil(quantile * places.count())
    found = places.where(F.col("place") == max(rank, 1) - 1).first()
    return found["score"] if found else 0.0


def predict_language(documents: DataFrame, net: Network | None, columns: list[str] | None = None,
                     text_column: str = "text", keep_text: bool = False) -> DataFrame:
    """``columns`` (default: doc_id) with ``lang_pred`` and ``score`` (its pooled probability) for each document.

    With ``keep_text`` the text is returned as well; it goes through Python once either way.

    A text that is null or has no letter is ``und`` with score 0, and so is every text when there was nothing
    to learn from. Every byte of every text is labelled; ties go to the first language in code point order. What is labelled
    OTHER counts for no language, so a text in a script that no learnt language uses has a low score.
    """
    columns = columns or ["doc_id"]
    lettered = F.coalesce(F.col(text_column).rlike("\\p{L}"), F.lit(False))
    rows = documents.select(F.struct(*columns).alias("_row"), F.col(text_column).alias("_text"),
                            lettered.alias("_lettered"))
    shared = documents.sparkSession.sparkContext.broadcast(net)     # a few thousand numbers

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            for part in slices(batch, "_text", 1 << 19):
                lettered = np.array(part.column("_lettered").to_pylist(), bool) & (net is not None)
                if net is None:
                    names, scores = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
                else:
                    p = document_probabilities(net, part.column("_text"))[:, :len(net.learnt())]
                    best = p.argmax(axis=1)
                    names = [net.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), lettered.tolist())]
                    scores = np.where(lettered, p.max(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in carried), pa.array(names, pa.string()), pa.array(scores)],
                    [*carried, "lang_pred", "score"])

    carried = ["_row", "_text"] if keep_text else ["_row"]
    schema = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in carried)
    text = [F.col("_text").alias(text_column)] if keep_text else []
    return rows.mapInArrow(predict, schema + "lang_pred string, score double").select(
        "_row.*", *text, "lang_pred", "score")
