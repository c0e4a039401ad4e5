"""Learning-rate schedule and step counts as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the training recipe.
BASE_RATE = 2e-4
WARMUP_RATIO = 0.03
ACCUMULATION = 8


def total_steps(n_examples: Column, world_size: int, batch: int = 1,
                accum: int = ACCUMULATION) -> Column:
    """Optimizer steps of one epoch; the last step may be short."""
    micro = F.ceil(n_examples / F.lit(batch * world_size))
    return F.ceil(micro / F.lit(accum)).cast("bigint")


def learning_rate(step: Column, total: Column, base: float = BASE_RATE,
                  warmup_ratio: float = WARMUP_RATIO) -> Column:
    """Linear warm-up, then half a cosine to zero; ``step`` counts from 0."""
    warm = F.ceil(total * F.lit(warmup_ratio))
    rising = F.lit(base) * step / F.greatest(warm, F.lit(1))
    progress = (step - warm) / F.greatest(total - warm, F.lit(1))
    falling = F.lit(base) * F.lit(0.5) * (F.lit(1.0) + F.cos(F.pi() * progress))
    return F.when(step < warm, rising).otherwise(falling)
