"""Queries on run metrics, parameters, checkpoints, experiments and artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fitledger.catalog.tables import entries, examples, logs, stored, table
from fitledger.functions import is_number
from fitledger.operators import checkpoints as ck, metrics as m, registry as reg
from fitledger.operators.examples import render_examples
from fitledger.session import saved_table, scratch_path
from fitledger.sources import sinks
from fitledger.sources.artifacts import artifact_manifest, file_listing
from fitledger.sources.derived import run_settings
from fitledger.sources.log_table import read_logs, store_logs
from fitledger.sources.sinks import write_training_text

SETTINGS = ["epochs", "per_device_train_batch_size", "grad_accum", "lr",
            "n_events", "max_value", "first_kind", "had_error"]


def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs(spark, sf_dir).select("run_id", "event_id", "step", "kind", "rank")


def number_types(spark, sf_dir):
    rows = stored(spark, entries(spark, sf_dir))
    found = spark.tvf.variant_explode(F.col("entry").outer())
    return rows.lateralJoin(found).groupBy("key").agg(
        F.count_if(is_number(F.col("value"))).alias("numbers"),
        F.count_if(~is_number(F.col("value"))).alias("dropped"),
    )


def lead_rank(spark, sf_dir):
    return m.lead_rank_only(logs(spark, sf_dir)).select("run_id", "event_id", "step")


def snapshots(spark, sf_dir):
    return m.every_n_steps(logs(spark, sf_dir)).select("run_id", "event_id", "step")


def loggable_rows(spark, sf_dir):
    return m.loggable(stored(spark, entries(spark, sf_dir))).select("run_id", "event_id")


def malformed(spark, sf_dir):
    """Event properties are JSON, prose is not."""
    shape = ["run_id", "event_id", "logs"]
    props = table(spark, sf_dir, "events").select("user_id", "event_id", "props").toDF(*shape)
    prose = table(spark, sf_dir, "documents").select(F.lit(-1).cast("bigint"), "doc_id", "text").toDF(*shape)
    path = scratch_path(spark, "logs")
    store_logs(props.unionByName(prose), path)
    return m.malformed_logs(read_logs(spark, path, accepted=False)).select("run_id", "event_id")


def _points(rows: DataFrame) -> DataFrame:
    # Seven places: a tenth of a microsecond, where step times end.
    return rows.select("run_id", "event_id", "key", F.round("value", 7).alias("value"), "step")


def long_metrics(spark, sf_dir):
    return _points(m.metrics_long(stored(spark, logs(spark, sf_dir))))


def step_times(spark, sf_dir):
    return m.time_per_step(stored(spark, entries(spark, sf_dir))).select(
        "run_id", "event_id", F.round("time_per_step", 7).alias("time_per_step"))


def step_time_points(spark, sf_dir):
    return _points(m.timing_metrics(stored(spark, logs(spark, sf_dir))))


def evaluation(spark, sf_dir):
    return _points(m.eval_metrics(stored(spark, logs(spark, sf_dir))))


def final_points(spark, sf_dir):
    return _points(m.final_metrics(stored(spark, entries(spark, sf_dir))))


def _stored_metrics(spark, sf_dir):
    """The metric table, so that what follows does not parse the logs again."""
    path = scratch_path(spark, "metrics")
    sinks.append_metrics(m.recorded_metrics(stored(spark, logs(spark, sf_dir))), path)
    return sinks.read_metrics(spark, path)


def history(spark, sf_dir):
    numbered = m.metric_history(_stored_metrics(spark, sf_dir))
    return numbered.select("run_id", "key", "seq", "step", F.round("value", 7).alias("value"))


def blocks(spark, sf_dir):
    numbered = m.metric_history(_stored_metrics(spark, sf_dir))
    return m.history_blocks(numbered, 20).select(
        "run_id", "key", "block",
        F.size("points").cast("bigint").alias("n_points"),
        F.element_at("points", 1)["step"].alias("first_step"),
        F.round(F.element_at("points", -1)["value"], 7).alias("last_value"),
    )


def summaries(spark, sf_dir):
    found = m.run_summary(_stored_metrics(spark, sf_dir), "value")
    return found.withColumns({
        c: F.round(c, 6) for c in ("first_value", "last_value", "best_value")})


def _params(spark, sf_dir):
    return reg.melt_params(run_settings(entries(spark, sf_dir)), "run_id", SETTINGS)


def _params_checked(rows: DataFrame) -> DataFrame:
    """Numbers compared as numbers: engines print doubles differently."""
    numeric = F.col("value_type").isin("int", "float")
    return rows.select(
        "run_id", "key", "value_type",
        F.round(F.when(numeric, F.col("value").try_cast("double")), 6).alias("number"),
        F.when(~numeric, F.col("value")).alias("text"),
    )


def side_by_side(spark, sf_dir):
    wide = m.params_side_by_side(_params(spark, sf_dir), SETTINGS)
    numbers = {c: F.round(F.col(c).try_cast("double"), 6).alias(c) for c in ("lr", "max_value")}
    return wide.select("run_id", *[numbers.get(c, F.col(c)) for c in SETTINGS])


def hooked(spark, sf_dir):
    return _points(m.log_hook(stored(spark, logs(spark, sf_dir))))


def appended_metrics(spark, sf_dir):
    """Two appends, dealt into different numbers of buckets."""
    path = scratch_path(spark, "metrics")
    rows = stored(spark, logs(spark, sf_dir))
    sinks.append_metrics(m.log_hook(rows), path)
    sinks.append_metrics(m.eval_metrics(m.lead_rank_only(rows)), path, buckets=16)
    return _points(sinks.read_metrics(spark, path))


def appended_params(spark, sf_dir):
    path = scratch_path(spark, "params")
    sinks.append_params(_params(spark, sf_dir), path)
    return _params_checked(spark.read.parquet(path))


def appended_tags(spark, sf_dir):
    path = scratch_path(spark, "tags")
    tags = table(spark, sf_dir, "documents").select(
        F.col("doc_id"), F.col("lang").alias("language"), F.col("source").alias("dataset"))
    sinks.append_tags(reg.melt_params(tags, "doc_id", ["language", "dataset"]), path)
    return spark.read.parquet(path)


def due_checkpoints(spark, sf_dir):
    return ck.checkpoint_plan(logs(spark, sf_dir))


def kept_checkpoints(spark, sf_dir):
    return ck.retain_latest(ck.checkpoint_plan(logs(spark, sf_dir)))


def _checkpoint_files(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The plan of due checkpoints, and the files that a job has written for them: none where its event is an error."""
    due = m.every_n_steps(logs(spark, sf_dir), ck.SAVE_STEPS).select("run_id", "step", "event_id", "logs")
    due = saved_table(due, "due-rows")
    directory = scratch_path(spark, "checkpoints")
    kind = F.try_variant_get(F.try_parse_json("logs"), "$.event_type", "string")
    states = due.filter(kind != "error").select(
        "run_id", F.format_string(ck.FOLDER_FORMAT, "step").alias("path"), "event_id", "logs")
    ck.write_checkpoints(states, directory)
    return ck.checkpoint_plan(due), file_listing(spark, directory)


def present_checkpoints(spark, sf_dir):
    plan, files = _checkpoint_files(spark, sf_dir)
    return ck.existing_only(plan, ck.checkpoint_folders(files))


def expired_checkpoints(spark, sf_dir):
    """The folders that retention would remove."""
    _, files = _checkpoint_files(spark, sf_dir)
    return ck.expired(ck.steps_of(ck.checkpoint_folders(files)))


def pending(spark, sf_dir):
    plan, files = _checkpoint_files(spark, sf_dir)
    return ck.pending_uploads(plan, ck.checkpoint_folders(files))


def _experiments(spark, sf_dir):
    existing = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("run-"), "s_suppkey").alias("experiment"))
    incoming = table(spark, sf_dir, "events").select(
        F.concat(F.lit("run-"), "user_id").alias("experiment"))
    return existing, incoming


def created_experiments(spark, sf_dir):
    return reg.new_experiments(*_experiments(spark, sf_dir))


def all_experiments(spark, sf_dir):
    return reg.register_experiments(*_experiments(spark, sf_dir))


def stored_experiments(spark, sf_dir):
    """Get-or-create on a stored registry, and again with the same names: the second call adds no row."""
    path = scratch_path(spark, "experiments")
    existing, incoming = _experiments(spark, sf_dir)
    reg.create_registry(spark, path)
    for names in (existing, incoming, incoming):
        reg.get_or_create(spark, path, names)
    return spark.read.schema("experiment string").parquet(path)


def experiment_names(spark, sf_dir):
    name = reg.experiment_name(F.concat(F.lit("run-"), "user_id"))
    # The user differs from machine to machine.
    below_user = F.regexp_replace(name, "^/Workspace/Users/[^/]+/", "~/")
    return table(spark, sf_dir, "events").select("user_id").distinct().select(
        "user_id", below_user.alias("experiment"))


def run_registry(spark, sf_dir):
    runs = table(spark, sf_dir, "events").withColumnRenamed("user_id", "run_id")
    registered = reg.register_runs(runs, F.lit("tuning"), F.concat(F.lit("run-"), "run_id"))
    # The user differs from machine to machine.
    at_home = F.endswith("experiment", F.concat(F.lit("/"), "username", F.lit("/tuning")))
    return registered.select("run_id", "run_name", at_home.alias("in_own_folder"))


def artifacts(spark, sf_dir):
    """The files of the training text that a job has written, as listed and as they are read: the same files, the same bytes,
    and in them all examples."""
    path = scratch_path(spark, "artifacts")
    write_training_text(render_examples(examples(spark, sf_dir)), path)
    listed = artifact_manifest(spark, path, "run-0", "training_text").filter(F.col("path").endswith(".parquet"))
    read = spark.read.schema("example_id string, text string").parquet(path).groupBy(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")).agg(F.count("text").alias("rows"))
    both = listed.join(read, "path", "left")
    return both.groupBy("run_id", "artifact_path").agg(
        F.sum(F.coalesce("rows", F.lit(0))).alias("examples"), F.bool_and(F.col("length") > 0).alias("has_bytes"),
        F.bool_and((F.col("length") == F.col("size")) | F.col("size").isNull()).alias("sizes_agree"),
        (F.count(F.lit(1)) == F.count_distinct("path")).alias("listed_once"),
        (F.count("modificationTime") == F.count(F.lit(1))).alias("timed"))


QUERIES = {
    "log_events": log_rows,
    "is_number": number_types,
    "lead_rank_only": lead_rank,
    "every_n_steps": snapshots,
    "loggable": loggable_rows,
    "malformed_logs": malformed,
    "metrics_long": long_metrics,
    "time_per_step": step_times,
    "timing_metrics": step_time_points,
    "eval_metrics": evaluation,
    "final_metrics": final_points,
    "metric_history": history,
    "history_blocks": blocks,
    "run_summary": summaries,
    "params_side_by_side": side_by_side,
    "log_hook": hooked,
    "append_metrics": appended_metrics,
    "append_params": appended_params,
    "append_tags": appended_tags,
    "checkpoint_plan": due_checkpoints,
    "retain_latest": kept_checkpoints,
    "existing_only": present_checkpoints,
    "expired_checkpoints": expired_checkpoints,
    "pending_uploads": pending,
    "new_experiments": created_experiments,
    "register_experiments": all_experiments,
    "get_or_create": stored_experiments,
    "experiment_name": experiment_names,
    "register_runs": run_registry,
    "artifact_manifest": artifacts,
}

LOG_SQL = """
log_events as (
  select user_id as run_id, event_id, ts, event_type, value,
    cast(json_extract(props, '$.k') as double) as k,
    10 * row_number() over (partition by user_id order by ts, event_id) as step,
    case event_type when 'signup' then 'evaluate' else 'log' end as kind,
    cast(event_id % 4 as integer) as rank
  from events
)"""

POINTS_SQL = f"""{LOG_SQL},
points as (
  select run_id, event_id, kind, rank, 'value' as key, round(value, 6) as value, step from log_events where value is not null
  union all
  select run_id, event_id, kind, rank, 'k', k, step from log_events where k is not null
)"""

_TIMES = f"""{LOG_SQL},
times as (
  select run_id, event_id, step,
    round((epoch_us(ts) - lag(epoch_us(ts)) over (partition by run_id order by ts, event_id)) / 1e7, 7) as seconds
  from log_events where kind = 'log'
)"""

_HOOKED = f"""{POINTS_SQL},
hooked as (
  select run_id, event_id, key, value, step from points where rank = 0 and kind = 'log'
  union all
  select run_id, event_id, 'time_per_step', seconds, step from (
    select run_id, event_id, step,
      (epoch_us(ts) - lag(epoch_us(ts)) over (partition by run_id order by ts, event_id)) / 1e7 as seconds
    from log_events where rank = 0 and kind = 'log'
  ) where seconds is not null
),
recorded as (
  select * from hooked
  union all
  select run_id, event_id, 'eval_' || key, value, step from points where rank = 0 and kind = 'evaluate'
)"""

_NUMBERED = f"""{_HOOKED},
numbered as (
  select run_id, event_id, key, round(value, 7) as value, step,
    row_number() over (partition by run_id, key order by step, event_id) as seq from recorded
)"""

_SETTINGS = """
settings as (
  select cast(user_id as varchar) as run_id, count(*) as n_events, max(value) as max_value,
    min(event_type) as first_kind, bool_or(event_type = 'error') as had_error
  from events group by user_id
)"""

_PLAN = f"""{LOG_SQL},
plan as (
  select run_id, step, event_type, 'checkpoint-' || step as path from log_events where step % 200 = 0
)"""

_NAMES = """
existing as (select 'run-' || s_suppkey as experiment from supplier),
created as (
  select distinct 'run-' || user_id as experiment from events
  where 'run-' || user_id not in (select experiment from existing)
)"""

SQL = {
    "log_events": f"with {LOG_SQL} select run_id, event_id, step, kind, rank from log_events",
    "is_number": """
select 'value' as key, count(value) as numbers, cast(0 as bigint) as dropped from events
union all select 'k', count(json_extract(props, '$.k')), 0 from events
union all select 'event_type', 0, count(event_type) from events""",
    "lead_rank_only": f"with {LOG_SQL} select run_id, event_id, step from log_events where rank = 0",
    "every_n_steps": f"with {LOG_SQL} select run_id, event_id, step from log_events where step % 100 = 0",
    "loggable": """
select user_id as run_id, event_id from events
where user_id is not null and (value is not null or event_type is not null or props is not null)""",
    "malformed_logs": """
select user_id as run_id, event_id from events where not json_valid(props)
union all
select -1, doc_id from documents where not json_valid(text)""",
    "metrics_long": f"with {POINTS_SQL} select run_id, event_id, key, value, step from points",
    "time_per_step": f"""
with {_TIMES} select run_id, event_id, seconds as time_per_step from times where seconds is not null""",
    "timing_metrics": f"""
with {_TIMES}
select run_id, event_id, 'time_per_step' as key, seconds as value, step from times where seconds is not null""",
    "eval_metrics": f"""
with {POINTS_SQL}
select run_id, event_id, 'eval_' || key as key, value, step from points where kind = 'evaluate'""",
    "final_metrics": f"""
with {POINTS_SQL}
select run_id, event_id, key, value, cast(0 as bigint) as step from points
where step = (select max(step) from log_events l where l.run_id = points.run_id and l.kind = 'log')""",
    "metric_history": f"with {_NUMBERED} select run_id, key, seq, step, value from numbered",
    "history_blocks": f"""
with {_NUMBERED}
select run_id, key, (seq - 1) // 20 as block, count(*) as n_points, min(step) as first_step,
  arg_max(value, seq) as last_value
from numbered group by run_id, key, (seq - 1) // 20""",
    "run_summary": f"""
with {LOG_SQL}
select run_id, count(*) as points, round(arg_min(value, step), 6) as first_value,
  round(arg_max(value, step), 6) as last_value, round(min(value), 6) as best_value, max(step) as last_step
from log_events where value is not null and kind = 'log' and rank = 0 group by run_id""",
    "params_side_by_side": f"""
with {_SETTINGS}
select run_id, '1' as epochs, '1' as per_device_train_batch_size, '8' as grad_accum, cast(0.0002 as double) as lr,
  cast(n_events as varchar) as n_events, round(max_value, 6) as max_value, first_kind,
  case when had_error then 'True' else 'False' end as had_error
from settings""",
    "log_hook": f"with {_HOOKED} select run_id, event_id, key, round(value, 7) as value, step from hooked",
    "append_metrics": f"with {_HOOKED} select run_id, event_id, key, round(value, 7) as value, step from recorded",
    "append_params": f"""
with {_SETTINGS}
select run_id, 'epochs' as key, 'int' as value_type, cast(1 as double) as number, cast(null as varchar) as text from settings
union all select run_id, 'per_device_train_batch_size', 'int', 1, null from settings
union all select run_id, 'grad_accum', 'int', 8, null from settings
union all select run_id, 'lr', 'float', 0.0002, null from settings
union all select run_id, 'n_events', 'int', n_events, null from settings
union all select run_id, 'max_value', 'float', round(max_value, 6), null from settings
union all select run_id, 'first_kind', 'str', null, first_kind from settings
union all select run_id, 'had_error', 'bool', null, if(had_error, 'True', 'False') from settings""",
    "append_tags": """
select cast(doc_id as varchar) as run_id, 'language' as key, lang as value, 'str' as value_type from documents
union all
select cast(doc_id as varchar), 'dataset', source, 'str' from documents""",
    "checkpoint_plan": f"with {_PLAN} select run_id, step, path from plan",
    "retain_latest": f"""
with {_PLAN}
select run_id, step, path from plan p
where (select count(*) from plan q where q.run_id = p.run_id and q.step > p.step) < 2""",
    "existing_only": f"with {_PLAN} select run_id, step, path from plan where event_type <> 'error'",
    "expired_checkpoints": f"""
with {_PLAN},
there as (select * from plan where event_type <> 'error')
select run_id, step, path from there p
where (select count(*) from there q where q.run_id = p.run_id and q.step > p.step) >= 2""",
    "pending_uploads": f"with {_PLAN} select run_id, step, path from plan where event_type = 'error'",
    "new_experiments": f"with {_NAMES} select experiment from created",
    "experiment_name": "select distinct user_id, '~/run-' || user_id as experiment from events",
    "register_runs": """
select distinct user_id as run_id, 'run-' || user_id as run_name, true as in_own_folder from events""",
    "artifact_manifest": """
select 'run-0' as run_id, 'training_text' as artifact_path, count(*) as examples,
  true as has_bytes, true as sizes_agree, true as listed_once, true as timed
from conversations where role = 'user'""",
    "get_or_create": f"with {_NAMES} select experiment from existing union select experiment from created",
    "register_experiments": f"with {_NAMES} select experiment from existing union select experiment from created",
}
