"""Lay examples out over epochs, ranks, micro-batches and optimizer steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from fitledger.functions.schedule import (
    ACCUMULATION, BASE_RATE, WARMUP_RATIO, learning_rate, total_steps,
)

SEED = 42
# 65,536 parts: enough for every task of a large cluster, and a small broadcast.
HEX_DIGITS = 4


def example_index(df: DataFrame, id_column: str, seed: int = SEED,
                  hex_digits: int = HEX_DIGITS) -> DataFrame:
    """Add ``idx``, a seeded shuffle order from 0 without gaps, and ``n_examples``.

    Examples are ordered by a hash. Its first hex digits split them into
    16^hex_digits even parts, which are numbered in parallel; the parts' start
    numbers come from a table with one row per part, small enough to broadcast
    at any data size.
    """
    if not 1 <= hex_digits <= 5:
        raise ValueError("hex_digits must be 1 to 5: one row per part is broadcast")
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(id_column).cast("string")))
    # As bytes the digest sorts like its hex digits and takes half the space.
    hashed = df.withColumns({
        "__part": F.substring(digest, 1, hex_digits), "__hash": F.unhex(digest)})
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("__part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    starts = (
        hashed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
        .select(
            "__part",
            F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"),
            F.sum("__n").over(everything).alias("n_examples"),
        )
    )
    in_part = Window.partitionBy("__part").orderBy("__hash", id_column)
    return (
        hashed.withColumn("__nth", F.row_number().over(in_part))
        .join(F.broadcast(starts), "__part")
        .withColumn("idx", F.col("__start") + F.col("__nth") - 1)
        .drop("__hash", "__part", "__start", "__nth")
    )


def assign_rank(df: DataFrame, world_size: int, batch: int = 1) -> DataFrame:
    """Deal consecutive batches to the ranks in turn."""
    return df.withColumn("rank", F.expr(f"cast(pmod(idx div {batch}, {world_size}) as int)"))


def assign_step(df: DataFrame, world_size: int, batch: int = 1,
                accum: int = ACCUMULATION) -> DataFrame:
    """Add the micro-batch number and the optimizer step (from 1)."""
    return (
        df.withColumn("micro", F.expr(f"idx div {batch} div {world_size}"))
        .withColumn("opt_step", F.expr(f"micro div {accum} + 1"))
    )


def epochs(df: DataFrame, n: int = 1) -> DataFrame:
    """Repeat the examples once per epoch, in the same order."""
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(n))))


def steps_per_epoch(df: DataFrame, world_size: int, batch: int = 1,
                    accum: int = ACCUMULATION) -> DataFrame:
    """One row: the number of examples and of optimizer steps."""
    return df.agg(F.count(F.lit(1)).alias("n_examples")).withColumn(
        "steps", total_steps(F.col("n_examples"), world_size, batch, accum))


def with_learning_rate(df: DataFrame, world_size: int, batch: int = 1, accum: int = ACCUMULATION,
                       base: float = BASE_RATE, warmup_ratio: float = WARMUP_RATIO,
                       n_epochs: int = 1) -> DataFrame:
    """Add the rate of each row's optimizer step, counted over all epochs."""
    per_epoch = total_steps(F.col("n_examples"), world_size, batch, accum)
    done = (F.col("epoch") - 1) * per_epoch if "epoch" in df.columns else F.lit(0)
    return df.withColumn("learning_rate", learning_rate(
        done + F.col("opt_step") - 1, per_epoch * n_epochs, base, warmup_ratio))


def lay_out(df: DataFrame, id_column: str, world_size: int, batch: int = 1,
            accum: int = ACCUMULATION, n_epochs: int = 1, seed: int = SEED) -> DataFrame:
    """The whole plan: order, rank, micro-batch, step, epoch and learning rate."""
    indexed = example_index(df, id_column, seed)
    placed = assign_step(assign_rank(indexed, world_size, batch), world_size, batch, accum)
    return with_learning_rate(epochs(placed, n_epochs), world_size, batch, accum, n_epochs=n_epochs)


def batch_summary(plan: DataFrame, tokens_column: str = "n_tokens") -> DataFrame:
    """Rows and tokens of each step and rank: how even the parallel input is."""
    return plan.groupBy("opt_step", "rank").agg(
        F.count(F.lit(1)).alias("examples"),
        F.sum(tokens_column).cast("bigint").alias("tokens"),
    )
