"""Incremental forms of the metric operators."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from fitledger import schemas
from fitledger.operators.checkpoints import FOLDER_FORMAT, SAVE_STEPS
from fitledger.operators.metrics import every_n_steps, hook_metrics

MAX_BYTES = 1 << 30
LATENESS = "1 hour"
# Fixed value: where a run's checkpoints are filed.
ARTIFACT_FOLDER = "checkpoints/"


def file_pattern(path: str) -> str:
    """A pattern, so that a single file is as good as a folder. Signs of patterns in the name are refused."""
    plain = path.rstrip("/")
    if re.search(r"[\[\]{}*?\\]", plain):
        raise ValueError(f"{path} has signs that a file pattern gives a meaning")
    return f"{plain[:-1]}[{plain[-1]}]"


def read_log_stream(spark: SparkSession, path: str, schema: StructType = schemas.LOG_EVENTS,
                    max_bytes_per_trigger: int = MAX_BYTES) -> DataFrame:
    """Log files as they land in a folder, or one file."""
    return (
        spark.readStream.schema(schema)
        .option("maxBytesPerTrigger", max_bytes_per_trigger)
        .parquet(file_pattern(path))
    )


def stream_metrics(stream: DataFrame) -> DataFrame:
    """Metric rows of log and evaluate events; stateless."""
    return hook_metrics(stream)


def stream_checkpoint_events(stream: DataFrame, every: int = SAVE_STEPS, existing: DataFrame | None = None,
                             lateness: str = LATENESS) -> DataFrame:
    """``run_id, step, path, artifact_path`` as steps that are due for a checkpoint arrive, each once.

    All ranks report a checkpoint, ``lateness`` apart at most by their ``ts``. What has been seen is forgotten when the
    stream is that much further, so the state holds the checkpoints of the last while and not of all time. Reports without
    a time are left out, and so are those that come later than that. With ``existing`` (run_id, path), checkpoints that
    aren't there are skipped.
    """
    due = every_n_steps(stream.select("run_id", "step", "ts").filter(
        (F.col("step") > 0) & F.col("ts").isNotNull()), every)
    named = due.withColumn("path", F.format_string(FOLDER_FORMAT, "step"))
    if existing is not None:
        there = existing.select("run_id", "path").distinct()
        named = named.join(there, ["run_id", "path"])
    once = named.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["run_id", "step"])
    return once.select("run_id", "step", "path", F.concat(F.lit(ARTIFACT_FOLDER), "path").alias("artifact_path"))
