"""Queries that drain a stream into a table and read the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fitledger import schemas
from fitledger.catalog.runs import LOG_SQL, POINTS_SQL
from fitledger.catalog.tables import entries, logs, path_of
from fitledger.session import scratch_path
from fitledger.sources.derived import log_entries
from fitledger.streaming import (
    drain, read_log_stream, read_sink, step_time_sink, stream_checkpoint_events, stream_metrics,
    stream_run_times, stream_time_per_step, table_sink,
)
from fitledger.streaming.sinks import STEP_TIMES


RANKS = 4


def _drained(spark: SparkSession, stream: DataFrame, label: str, n_sinks: int = 1) -> list[DataFrame]:
    place = scratch_path(spark, label)
    paths = [f"{place}/table-{i}" for i in range(n_sinks)]
    drain(stream, [table_sink(p, label) for p in paths], f"{place}/progress")
    return [read_sink(spark, p, stream.schema, label) for p in paths]


def _log_stream(spark, sf_dir):
    """The run log, written out as files and read back as a stream."""
    path = scratch_path(spark, "log-files")
    logs(spark, sf_dir).write.parquet(path)
    return read_log_stream(spark, path)


def _event_stream(spark, sf_dir):
    return log_entries(read_log_stream(spark, path_of(sf_dir, "events"), schemas.EVENTS))


def metrics(spark, sf_dir):
    rows, = _drained(spark, stream_metrics(_log_stream(spark, sf_dir)), "metrics")
    return rows.select("run_id", "event_id", "key", F.round("value", 6).alias("value"), "step")


def step_times(spark, sf_dir):
    rows = stream_time_per_step(_event_stream(spark, sf_dir), scratch_path(spark, "step-times"))
    return rows.select("run_id", "event_id", F.round("time_per_step", 7).alias("time_per_step"))


def carried_step_times(spark, sf_dir):
    """The sink alone, in a table beside another stream's."""
    place = scratch_path(spark, "carried-step-times")
    sink = step_time_sink(f"{place}/times", f"{place}/carry", "times")
    drain(_event_stream(spark, sf_dir), [sink], f"{place}/progress")
    rows = read_sink(spark, f"{place}/times", STEP_TIMES, "times")
    return rows.select("run_id", "event_id", F.round("time_per_step", 7).alias("time_per_step"))


def run_times(spark, sf_dir):
    """All entries in the order of a hash, by keyed state and timers; one entry long after the last lets time pass."""
    place = scratch_path(spark, "run-times")
    rows = entries(spark, sf_dir)
    closing = rows.agg(F.max("ts").alias("last")).select(
        F.lit(-1).cast("bigint").alias("run_id"), F.lit(-1).cast("bigint").alias("event_id"),
        (F.col("last") + F.expr("interval 15 days")).alias("ts"), F.lit("log").alias("kind"), F.lit(0).alias("rank"),
        F.lit('{"value":1}').alias("logs"))
    dealt = rows.unionByName(closing).withColumn("order", F.xxhash64("event_id"))
    dealt.repartition("order").sortWithinPartitions("order").drop("order").write.parquet(f"{place}/files")
    # One micro-batch: of two, all of the second would be late.
    arriving = read_log_stream(spark, f"{place}/files", max_bytes_per_trigger=1 << 62)
    times = stream_run_times(arriving, slice_seconds=10 * 86_400)
    drain(times, [table_sink(f"{place}/times", "times")], f"{place}/progress")
    found = read_sink(spark, f"{place}/times", times.schema, "times")
    return found.select("run_id", "event_id", F.round("time_per_step", 7).alias("time_per_step"))


def checkpoint_events(spark, sf_dir):
    """Each step as four ranks report it, a second apart."""
    path = scratch_path(spark, "rank-files")
    ranks = logs(spark, sf_dir).withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(RANKS - 1))))
    late = F.make_dt_interval(secs=F.col("rank").cast("decimal(18,6)"))
    ranks.withColumn("ts", F.col("ts") + late).write.parquet(path)
    rows, = _drained(spark, stream_checkpoint_events(read_log_stream(spark, path)), "checkpoints")
    return rows


def tee(spark, sf_dir):
    """Both tables, whole: each row with the tables that hold it."""
    lines = _log_stream(spark, sf_dir).withColumn("ts", F.unix_micros("ts"))
    first, second = _drained(spark, lines, "lines", n_sinks=2)
    both = first.withColumn("sink", F.lit(0)).unionByName(second.withColumn("sink", F.lit(1)))
    return both.select("run_id", "event_id", "kind", "step", "rank", F.col("ts").alias("micros"),
                       F.md5("logs").isNotNull().alias("has_logs"), "sink")


QUERIES = {
    "stream_metrics": metrics,
    "stream_time_per_step": step_times,
    "step_time_sink": carried_step_times,
    "stream_run_times": run_times,
    "stream_checkpoint_events": checkpoint_events,
    "tee_sink": tee,
}

_STEP_TIMES = """
select user_id as run_id, event_id,
  round((epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id order by ts, event_id)) / 1e7, 7) as time_per_step
from events where event_type <> 'signup' qualify time_per_step is not null"""

SQL = {
    "stream_metrics": f"""
with {POINTS_SQL}
select run_id, event_id, case kind when 'evaluate' then 'eval_' else '' end || key as key, value, step
from points""",
    "stream_time_per_step": _STEP_TIMES,
    "step_time_sink": _STEP_TIMES,
    "stream_run_times": _STEP_TIMES,
    "stream_checkpoint_events": f"""
with {LOG_SQL}
select run_id, step, 'checkpoint-' || step as path, 'checkpoints/checkpoint-' || step as artifact_path
from log_events where step % 200 = 0""",
    "tee_sink": f"""
with {LOG_SQL}
select run_id, event_id, kind, step, rank, epoch_us(ts) as micros, true as has_logs, cast(sink as integer) as sink
from log_events, range(2) as sinks(sink)""",
}
