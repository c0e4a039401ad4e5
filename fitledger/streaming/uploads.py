"""Uploads followed as two streams: which that were started have not been finished in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

WITHIN = "1 hour"
LATENESS = "10 minutes"


def follow_uploads(started: DataFrame, finished: DataFrame, within: str = WITHIN, lateness: str = LATENESS) -> DataFrame:
    """``run_id, path, started_at, finished_at`` of each started upload; ``finished_at`` is null for a pending one.

    ``started`` (run_id, path, started_at) and ``finished`` (run_id, path, finished_at) are streams, whose rows are at most
    ``lateness`` behind. An upload counts as finished if that happens ``within`` the time after its start; its row comes
    out then. When that time has passed in both streams without an end, its row comes out as pending. The state holds uploads
    of the last ``within`` plus ``lateness`` only. Ends without a start, and rows without a time, give nothing.
    """
    # A row without a time would stay in the state for ever.
    begun = started.filter("started_at is not null").select("run_id", "path", "started_at").withWatermark("started_at", lateness)
    ended = finished.filter("finished_at is not null").select(
        F.col("run_id").alias("ended_run"), F.col("path").alias("ended_path"), "finished_at",
    ).withWatermark("finished_at", lateness)
    same = (
        (F.col("run_id") == F.col("ended_run")) & (F.col("path") == F.col("ended_path"))
        & (F.col("finished_at") >= F.col("started_at"))
        & (F.col("finished_at") <= F.col("started_at") + F.expr(f"interval {within}"))
    )
    return begun.join(ended, same, "leftOuter").select("run_id", "path", "started_at", "finished_at")
