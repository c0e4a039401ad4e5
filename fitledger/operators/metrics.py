"""Run metrics: from logged key/value maps to long tables, timings and summaries."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from fitledger.functions.numbers import is_number, number_of
from fitledger.operators.ordered import ROWS_PER_SLOT, with_neighbour, with_row_number

# Fixed values of the training recipe and of the metric names.
LOGGING_STEPS = 10
SNAPSHOT_STEPS = 100
EVAL_PREFIX = "eval_"
LOG = "log"
EVALUATE = "evaluate"
END = "end"
TIME_PER_STEP = "time_per_step"
# Why a row of a log table was rejected.
NOT_JSON = "not JSON"

# Where the log is filed among a run's artifacts.
SNAPSHOT_FORMAT = "logs/step-%d"
FINAL_SNAPSHOT = "logs/final"

BLOCK_POINTS = 1_000


def lead_rank_only(df: DataFrame, rank_column: str = "rank") -> DataFrame:
    """Only global rank 0 records anything."""
    return df.filter(F.col(rank_column) == 0)


def every_n_steps(df: DataFrame, n: int = SNAPSHOT_STEPS, step_column: str = "step") -> DataFrame:
    """Rows whose step is a multiple of ``n``."""
    return df.filter(F.pmod(F.col(step_column), F.lit(n)) == 0)


def entry_of(df: DataFrame) -> Column:
    """The log map of a row: the stored VARIANT ``entry``, or else the text ``logs``, parsed here.

    A log table (:mod:`fitledger.sources.log_table`) has been parsed once; from text each operator parses anew.
    """
    return F.col("entry") if "entry" in df.columns else F.try_parse_json("logs")


def has_entry(df: DataFrame) -> Column:
    """Whether the log map is there and not empty."""
    shape = F.schema_of_variant(entry_of(df))
    return F.coalesce(shape.startswith("OBJECT<") & (shape != "OBJECT<>"), F.lit(False))


def log_snapshots(df: DataFrame, every: int = SNAPSHOT_STEPS, rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """``run_id, step, lines, path``: the log as it is filed at each ``every``-th step and at the end of a run.

    ``lines`` is how many entries the file holds, those up to the step; ``path`` is its place among the run's artifacts.
    A step of several entries is filed once, with all of them. Rows without a run or a step are in no file.
    """
    rows = df.filter(F.col("run_id").isNotNull() & F.col("step").isNotNull()).select("run_id", "step", "event_id")
    placed = with_row_number(rows, ["run_id"], ["step", "event_id"], "lines", rows_per_slot)
    due = every_n_steps(placed.filter(F.col("step") > 0), every).groupBy("run_id", "step").agg(F.max("lines").alias("lines"))
    end = rows.groupBy("run_id").agg(F.max("step").alias("step"), F.count(F.lit(1)).alias("lines"))
    return due.withColumn("path", F.format_string(SNAPSHOT_FORMAT, "step")).unionByName(
        end.withColumn("path", F.lit(FINAL_SNAPSHOT)))


def loggable(df: DataFrame) -> DataFrame:
    """Rows with a run and a non-empty log map (malformed logs count as empty)."""
    return df.filter(F.col("run_id").isNotNull() & has_entry(df))


def malformed_logs(df: DataFrame) -> DataFrame:
    """Rows whose log text is not JSON: kept apart, counted, never failing the job. Of a log table its rejected rows."""
    if "reason" in df.columns:
        return df.filter(F.col("reason") == NOT_JSON)
    return df.filter(F.col("logs").isNotNull() & F.try_parse_json("logs").isNull())


def metrics_long(df: DataFrame, key_prefix: Column | None = None) -> DataFrame:
    """``run_id, event_id, key, value, step, log_time``: one row per number in a log map."""
    prefix = F.lit("") if key_prefix is None else key_prefix
    outer = F.col("entry").outer() if "entry" in df.columns else F.try_parse_json(F.col("logs").outer())
    entries = df.sparkSession.tvf.variant_explode(outer)
    return (
        df.filter(F.col("run_id").isNotNull())
        .lateralJoin(entries)
        # A top-level array explodes without keys.
        .filter(F.col("key").isNotNull() & is_number(F.col("value")))
        .select(
            "run_id", "event_id",
            F.concat(prefix, F.col("key")).alias("key"),
            number_of(F.col("value")).alias("value"),
            "step",
            F.col("ts").alias("log_time"),
        )
    )


def eval_metrics(df: DataFrame) -> DataFrame:
    """Metrics of the evaluate events; the prefix is added even to keys that carry it."""
    return metrics_long(df.filter(F.col("kind") == EVALUATE), F.lit(EVAL_PREFIX))


def hook_metrics(df: DataFrame) -> DataFrame:
    """Metrics of log and evaluate events in one pass, each named as its hook names them."""
    return metrics_long(df, F.when(F.col("kind") == EVALUATE, EVAL_PREFIX).otherwise(""))


def log_entries_only(df: DataFrame) -> DataFrame:
    """Loggable rows of log events: what the log hook records."""
    return loggable(df.filter(F.col("kind") == LOG))


def final_metrics(df: DataFrame) -> DataFrame:
    """Numbers of each run's last loggable log entry, recorded without a step of their own (step 0).

    Entries without a time come before all others; those of one time are in the order of their events. The
    rank filter is applied per task before the shuffle too, so each task sends one row for each run.
    """
    entries = log_entries_only(df)
    entries = entries.select("run_id", "event_id", "ts", "entry" if "entry" in df.columns else "logs")
    newest = Window.partitionBy("run_id").orderBy(F.col("ts").desc_nulls_last(), F.col("event_id").desc_nulls_last())
    last = entries.withColumn("age", F.row_number().over(newest)).filter("age = 1").drop("age")
    return metrics_long(last.withColumn("step", F.lit(0).cast("bigint")))


def elapsed_per_step(micros: Column, logging_steps: int = LOGGING_STEPS) -> Column:
    """Elapsed microseconds to seconds per step, in one division."""
    return micros / F.lit(1e6 * max(logging_steps, 1))


def clock_events(df: DataFrame) -> DataFrame:
    """Rows that move a run's clock: loggable log entries, and the end events that stop it."""
    timed = df.filter(F.col("run_id").isNotNull() & F.col("ts").isNotNull() & F.col("kind").isin(LOG, END))
    return timed.filter((F.col("kind") == END) | has_entry(df))


def time_per_step(df: DataFrame, logging_steps: int = LOGGING_STEPS,
                  rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """Seconds per step since the run's previous log entry; none for the first entry.

    Evaluate events, empty logs and rows without a time are no log entries. An end
    event isn't one either, and what follows it starts afresh.
    """
    return step_times(clock_events(df), logging_steps, rows_per_slot)


def step_times(clocked: DataFrame, logging_steps: int = LOGGING_STEPS,
               rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """The same for rows of :func:`clock_events`."""
    timed = with_neighbour(clocked, ["run_id"], ["ts", "event_id"], ["ts", "kind"], "before", -1, rows_per_slot)
    elapsed = F.unix_micros("ts") - F.unix_micros("before.ts")
    return (
        timed.filter(F.col("before").isNotNull() & (F.col("kind") != END) & (F.col("before.kind") != END))
        .withColumn(TIME_PER_STEP, elapsed_per_step(elapsed, logging_steps))
        .drop("before")
    )


def timing_metrics(df: DataFrame, logging_steps: int = LOGGING_STEPS,
                   rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """The step times as metric rows, to be recorded beside the logged ones."""
    return time_per_step(df, logging_steps, rows_per_slot).select(
        "run_id", "event_id", F.lit(TIME_PER_STEP).alias("key"),
        F.col(TIME_PER_STEP).alias("value"), "step", F.col("ts").alias("log_time"),
    )


def log_hook(df: DataFrame, logging_steps: int = LOGGING_STEPS,
             rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """Everything the log hook records: on the lead rank, for each non-empty log entry of a run,
    its numbers and its step time."""
    lead = lead_rank_only(df)
    return metrics_long(log_entries_only(lead)).unionByName(timing_metrics(lead, logging_steps, rows_per_slot))


def recorded_metrics(df: DataFrame, logging_steps: int = LOGGING_STEPS,
                     rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """What the hooks of a run record: log entries and, under their own keys, evaluations."""
    return log_hook(df, logging_steps, rows_per_slot).unionByName(eval_metrics(lead_rank_only(df)))


def metric_history(metrics: DataFrame, rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """Number the points of each run and key in step order: ``.., seq``."""
    return with_row_number(metrics, ["run_id", "key"], ["step", "event_id"], "seq", rows_per_slot)


def history_blocks(history: DataFrame, block_points: int = BLOCK_POINTS) -> DataFrame:
    """Series as arrays of ``(step, value)``, at most ``block_points`` per row.

    A long series takes several rows, so no row grows with the run.
    """
    block = F.floor((F.col("seq") - 1) / F.lit(block_points)).alias("block")
    points = F.sort_array(F.collect_list(F.struct("seq", "step", "value")))
    return history.groupBy("run_id", "key", block).agg(
        F.transform(points, lambda p: F.struct(p["step"].alias("step"), p["value"].alias("value")))
        .alias("points")
    )


def _in_order(step: Column, event: Column) -> Column:
    """Step, then event, as one number, so that a hash aggregate can keep the least and the greatest.

    Null comes before all numbers. Steps are told apart up to 4 * 10^18 to either side.
    """
    low = F.lit(-(1 << 63))
    bound = F.lit(4 * 10**18)
    place = F.greatest(F.least(F.coalesce(step.cast("long"), low), bound), -bound - F.when(step.isNull(), 1).otherwise(0))
    return place.cast("decimal(19,0)") * F.lit(Decimal(2 * 10**19)) + (
        F.coalesce(event.cast("long"), low).cast("decimal(20,0)") + F.lit(Decimal(1 << 63)))


def run_summary(metrics: DataFrame, key: str) -> DataFrame:
    """First, last and best (lowest) value of one metric per run; ties of a step by event.

    Points without a step come before all others; a run that has only such has no last step, but a first, last and
    best value. One hash aggregate over one scan.
    """
    rows = metrics.filter(F.col("key") == key).select(
        "run_id", "step", "value", _in_order(F.col("step"), F.col("event_id")).alias("place"))
    return rows.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("points"), F.min_by("value", "place").alias("first_value"),
        F.max_by("value", "place").alias("last_value"), F.min("value").alias("best_value"),
        F.max("step").alias("last_step"))


def params_side_by_side(params: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per run, one column per listed parameter."""
    return params.groupBy("run_id").pivot("key", list(keys)).agg(F.max("value"))
