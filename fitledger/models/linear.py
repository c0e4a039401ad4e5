"""The fitted text classifier as a plain numpy model, to run where MLlib does not."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.ml import PipelineModel

# Fixed values of the 32-bit MurmurHash3 and its seed in MLlib's hashing of terms.
SEED, C1, C2, ROUND, FINAL1, FINAL2 = 42, 0xCC9E2D51, 0x1B873593, 0xE6546B64, 0x85EBCA6B, 0xC2B2AE35
_MASK = 0xFFFFFFFF


def murmur3(data: bytes, seed: int = SEED) -> int:
    """MurmurHash3 (x86, 32 bits), unsigned."""
    h = seed
    whole = len(data) & ~3
    for at in range(0, whole, 4):
        h ^= _scrambled(int.from_bytes(data[at:at + 4], "little"))
        h = _rotated(h, 13) * 5 + ROUND & _MASK
    if whole < len(data):
        h ^= _scrambled(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    h = (h ^ h >> 16) * FINAL1 & _MASK
    h = (h ^ h >> 13) * FINAL2 & _MASK
    return h ^ h >> 16


def _scrambled(k: int) -> int:
    return _rotated(k * C1 & _MASK, 15) * C2 & _MASK


def _rotated(x: int, bits: int) -> int:
    return (x << bits | x >> 32 - bits) & _MASK


@dataclass
class LinearTextModel:
    """Weights of hashed words: tokens are those of the library, terms are hashed as MLlib hashes them."""

    weights: np.ndarray
    intercept: float

    def slots(self, words: list[str]) -> np.ndarray:
        return np.fromiter((_slot(w, len(self.weights)) for w in words), np.int64, len(words))

    def scores(self, texts) -> np.ndarray:
        """P(class 1) of each text; null counts as empty."""
        margins = [self.weights[self.slots((t or "").split())].sum() + self.intercept for t in texts]
        return 1 / (1 + np.exp(-np.array(margins, float)))


@lru_cache(maxsize=1 << 18)
def _slot(word: str, size: int) -> int:
    h = murmur3(word.encode())
    return (h - (1 << 32) if h >> 31 else h) % size


def linear_text_model(model: PipelineModel) -> LinearTextModel:
    """The weights of a model of :func:`fitledger.models.supervised_fit`."""
    fitted = model.stages[-1]
    return LinearTextModel(fitted.coefficients.toArray(), float(fitted.intercept))


def loader(spark, model: LinearTextModel) -> Callable:
    """What :func:`fitledger.models.foreign_scores` loads in each worker process: the weights travel once."""
    shared = spark.sparkContext.broadcast(model)        # as many numbers as there are slots
    return lambda: shared.value.scores
