"""The same function on every rank, as one barrier stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def run_per_rank(df: DataFrame, fn: Callable, world_size: int, schema: str, **kwargs) -> DataFrame:
    """Run ``fn(context, batches, **kwargs)`` on ``world_size`` ranks; rank 0's result is the table.

    ``batches`` iterates over the rank's share of the rows as pandas frames.
    ``context`` is the barrier context: ``partitionId()`` is the rank,
    ``allGather(text)`` exchanges small messages. All ranks start together, so
    the cluster needs as many free slots; if one fails, all are run again.
    """

    def on_rank(batches):
        from pyspark import BarrierTaskContext

        context = BarrierTaskContext.get()
        result = fn(context, batches, **kwargs)
        context.barrier()
        if context.partitionId() == 0 and result is not None:
            yield result

    return df.repartition(world_size).mapInPandas(on_rank, schema, barrier=True)
