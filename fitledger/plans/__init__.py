"""Batch layout of a data-parallel run."""

from fitledger.plans.batches import (
    assign_rank, assign_step, batch_summary, epochs, example_index, lay_out,
    steps_per_epoch, with_learning_rate,
)

__all__ = [
    "assign_rank", "assign_step", "batch_summary", "epochs", "example_index", "lay_out",
    "steps_per_epoch", "with_learning_rate",
]
