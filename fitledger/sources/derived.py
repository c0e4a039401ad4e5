"""Run logs, registries and manifests derived from the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fitledger.functions.schedule import ACCUMULATION, BASE_RATE
from fitledger.operators.metrics import EVALUATE, LOGGING_STEPS
from fitledger.operators.ordered import ROWS_PER_SLOT, with_row_number


def log_events(events: DataFrame, logging_steps: int = LOGGING_STEPS,
               rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """Events as run log entries: a user is a run, its n-th event is step n*logging_steps."""
    renamed = log_entries(events)
    numbered = with_row_number(renamed, ["run_id"], ["ts", "event_id"], "nth", rows_per_slot)
    return numbered.withColumn("step", F.col("nth") * logging_steps).drop("nth")


def log_entries(events: DataFrame) -> DataFrame:
    """Log entries without their step; a projection, so it also works on a stream."""
    props = F.try_parse_json("props")
    logs = F.to_json(F.struct(
        "value", "event_type", F.try_variant_get(props, "$.k", "bigint").alias("k")))
    return events.select(
        F.col("user_id").alias("run_id"),
        "event_id",
        # Event times carry no zone and are read as UTC, whatever zone the session has.
        F.convert_timezone(F.lit("UTC"), F.current_timezone(), "ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") == "signup", EVALUATE).otherwise("log").alias("kind"),
        F.pmod(F.col("event_id"), F.lit(4)).cast("int").alias("rank"),
        logs.alias("logs"),
    )


def run_settings(logs: DataFrame) -> DataFrame:
    """One row of typed parameters per run, some fixed by the recipe, some seen in its log."""
    # Parsed once, in a step of its own.
    entries = logs.select("run_id", F.try_parse_json("logs").alias("entry")).select(
        "run_id",
        F.try_variant_get("entry", "$.value", "double").alias("value"),
        F.try_variant_get("entry", "$.event_type", "string").alias("event_type"),
    )
    return entries.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.max("value").alias("max_value"),
        F.min("event_type").alias("first_kind"),
        F.bool_or(F.col("event_type") == "error").alias("had_error"),
    ).withColumns({
        "epochs": F.lit(1),
        "per_device_train_batch_size": F.lit(1),
        "grad_accum": F.lit(ACCUMULATION),
        "lr": F.lit(BASE_RATE),
    })
