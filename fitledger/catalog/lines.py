"""Queries on log files read line by line, on uploads as streams, and on tables kept per append or per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fitledger.catalog import runs
from fitledger.catalog.tables import entries, logs, stored, table
from fitledger.catalog.text import SQL as TEXT_SQL, TOP_WORDS, document_tokens
from fitledger.operators import checkpoints as ck, metrics as m, registry as reg
from fitledger.operators.length_sketches import RANK_ERROR, append_lengths, merged_profile, read_lengths
from fitledger.operators.vocabulary import frequent_words
from fitledger.session import saved_table, scratch_path
from fitledger.sources.derived import run_settings
from fitledger.sources.log_table import parse_lines, write_log_rows
from fitledger.sources.run_tables import save_by_run, series_and_params
from fitledger.streaming import (
    drain, follow_uploads, line_sink, read_line_counts, read_line_stream, read_lines, read_log_stream, read_sink, table_sink,
)

CAPS = [1024, 2048]


def _lines(events: DataFrame) -> DataFrame:
    """Events as lines of runs' logs. Some are broken: half-written, prose, a list, without a run, empty."""
    whole = F.concat(
        F.lit('{"run_id":'), "user_id", F.lit(',"event_id":'), "event_id", F.lit(',"kind":"'),
        F.when(F.col("event_type") == "signup", "evaluate").otherwise("log"), F.lit('","logs":'), "props", F.lit("}"))
    event = F.col("event_id")
    line = (
        F.when(event % 11 == 0, F.col("event_type")).when(event % 7 == 0, F.expr("left(whole, length(whole) div 2)"))
        .when(event % 13 == 0, F.concat(F.lit("["), "event_id", F.lit("]")))
        .when(event % 17 == 0, F.concat(F.lit('{"event_id":'), "event_id", F.lit("}")))
        .when(event % 19 == 0, "").otherwise(F.col("whole"))
    )
    return events.withColumn("whole", whole).select(line.alias("value"))


def _log_files(spark: SparkSession, sf_dir: str) -> str:
    """The run log as text files, as runs write it."""
    path = scratch_path(spark, "line-files")
    _lines(table(spark, sf_dir, "events")).write.text(path)
    return path


def log_lines(spark, sf_dir):
    """Accepted rows and rejected lines, each with its reason: together all lines."""
    place = scratch_path(spark, "lines")
    drain(read_line_stream(spark, _log_files(spark, sf_dir)), [line_sink(place, "log")], f"{place}/progress")
    good = read_lines(spark, place).select(
        "run_id", "event_id", "kind", F.try_variant_get("entry", "$.k", "bigint").alias("k"), "reason", "line")
    bad = read_lines(spark, place, accepted=False).select(
        "run_id", F.lit(None).cast("bigint").alias("event_id"), "kind", F.lit(None).cast("bigint").alias("k"), "reason", "line")
    return good.unionByName(bad)


def line_counts(spark, sf_dir):
    """Lines and rejects as counted on the way, in a batch and in a stream."""
    path = _log_files(spark, sf_dir)
    found = write_log_rows(parse_lines(spark.read.text(path)), scratch_path(spark, "batch-lines"))
    batch = spark.createDataFrame([("batch", found["rows"], found["rejected"])], "way string, rows long, rejected long")
    place = scratch_path(spark, "stream-lines")
    drain(read_line_stream(spark, path), [line_sink(place, "log")], f"{place}/progress")
    stream = read_line_counts(spark, place).agg(
        F.lit("stream").alias("way"), F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected"))
    return batch.unionByName(stream)


def _uploads(spark, sf_dir) -> DataFrame:
    """Started uploads and when they finished, if they did: errors never do, others take up to two hours."""
    due = m.every_n_steps(logs(spark, sf_dir), ck.SAVE_STEPS)
    kind = F.try_variant_get(F.try_parse_json("logs"), "$.event_type", "string")
    took = F.make_dt_interval(mins=(F.col("event_id") % 120).cast("int"))
    return due.select(
        "run_id", F.format_string(ck.FOLDER_FORMAT, "step").alias("path"), F.col("ts").alias("started_at"),
        F.when(kind != "error", F.col("ts") + took).alias("finished_at"))


def followed_uploads(spark, sf_dir):
    """Uploads of all checkpoints, followed in two streams; those that took over an hour, or for ever, are pending."""
    rows = saved_table(_uploads(spark, sf_dir), "uploads")
    # A last upload long after all others tells the streams that time has passed.
    closing = rows.agg(F.max("started_at").alias("last")).select(
        F.lit(-1).cast("bigint").alias("run_id"), F.lit("end").alias("path"),
        (F.col("last") + F.expr("interval 10 days")).alias("started_at"),
        (F.col("last") + F.expr("interval 10 days")).alias("finished_at"))
    place = scratch_path(spark, "uploads")
    everything = rows.unionByName(closing)
    everything.select("run_id", "path", "started_at").write.parquet(f"{place}/started")
    everything.select("run_id", "path", "finished_at").filter("finished_at is not null").write.parquet(f"{place}/finished")

    def stream(name: str, column: str) -> DataFrame:
        return read_log_stream(spark, f"{place}/{name}", everything.select("run_id", "path", column).schema)

    found = follow_uploads(stream("started", "started_at"), stream("finished", "finished_at"))
    drain(found, [table_sink(f"{place}/found", "uploads")], f"{place}/progress")
    done = read_sink(spark, f"{place}/found", found.schema, "uploads").filter("run_id >= 0")
    return done.select("run_id", "path", F.col("finished_at").isNull().alias("pending"))


def snapshots_of_logs(spark, sf_dir):
    return m.log_snapshots(logs(spark, sf_dir))


def lengths_per_append(spark, sf_dir):
    """Documents sketched source by source; the merged profile is within the sketches' error of the exact one."""
    path = scratch_path(spark, "lengths")
    lengths = saved_table(document_tokens(spark, sf_dir).select("doc_id", F.size("tokens").alias("n_tokens")), "document-lengths")
    for part in range(3):
        append_lengths(lengths.filter(F.pmod("doc_id", F.lit(3)) == part), path, f"append-{part}", groups=4)
    profile = merged_profile(read_lengths(spark, path), CAPS)
    exact = lengths.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("n_tokens") > cap).alias(f"true_{cap}") for cap in CAPS])
    # One row each, put side by side.
    both = profile.unionByName(exact, allowMissingColumns=True)
    both = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return both.select(
        "examples", "tokens", "longest",
        *[(F.abs(F.col(f"over_{cap}") - F.col(f"true_{cap}")) <= RANK_ERROR * F.col("n")).alias(f"near_{cap}") for cap in CAPS])


def words_by_summary(spark, sf_dir):
    return frequent_words(document_tokens(spark, sf_dir), TOP_WORDS)


def series_with_params(spark, sf_dir):
    """Each run's series of one metric, summed up, beside its parameters: two tables bucketed by run."""
    place = scratch_path(spark, "by-run")
    points = m.recorded_metrics(stored(spark, logs(spark, sf_dir)))
    params = reg.melt_params(run_settings(entries(spark, sf_dir)), "run_id", runs.SETTINGS)
    tables = [spark.table(save_by_run(rows, f"{place}/{name}", buckets=16))
              for name, rows in (("points", points), ("params", params))]
    found = series_and_params(*tables, "value", runs.SETTINGS)
    numbers = ["first_value", "last_value", "best_value"]
    return found.select(
        "run_id", "points", *[F.round(c, 6).alias(c) for c in numbers], "last_step", "n_events", "had_error",
        F.round(F.col("max_value").try_cast("double"), 6).alias("max_value"))


QUERIES = {
    "log_lines": log_lines,
    "line_counts": line_counts,
    "follow_uploads": followed_uploads,
    "log_snapshots": snapshots_of_logs,
    "merged_profile": lengths_per_append,
    "frequent_words": words_by_summary,
    "series_and_params": series_with_params,
}

_LINES = """
whole as (
  select *, '{"run_id":' || user_id || ',"event_id":' || event_id || ',"kind":"'
    || case event_type when 'signup' then 'evaluate' else 'log' end || '","logs":' || props || '}' as whole
  from events
),
lines as (
  select *, case when event_id % 11 = 0 then 'not JSON' when event_id % 7 = 0 then 'not JSON'
      when event_id % 13 = 0 then 'not an object' when event_id % 17 = 0 then 'no run'
      when event_id % 19 = 0 then 'empty' end as reason,
    case when event_id % 11 = 0 then event_type when event_id % 7 = 0 then left(whole, length(whole) // 2)
      when event_id % 13 = 0 then '[' || event_id || ']' when event_id % 17 = 0 then '{"event_id":' || event_id || '}'
      when event_id % 19 = 0 then '' end as line
  from whole
)"""

SQL = {
    "log_lines": f"""
with {_LINES}
select case when reason is null then user_id end as run_id, case when reason is null then event_id end as event_id,
  case when reason is null then case event_type when 'signup' then 'evaluate' else 'log' end end as kind,
  case when reason is null then cast(json_extract(props, '$.k') as bigint) end as k, reason, line
from lines""",
    "line_counts": f"""
with {_LINES}
select way, count(*) as rows, count(reason) as rejected from lines, (values ('batch'), ('stream')) ways(way) group by way""",
    "follow_uploads": f"""
with {runs._PLAN}
select p.run_id, path, p.event_type = 'error' or l.event_id % 120 > 60 as pending
from plan p join log_events l using (run_id, step)""",
    "log_snapshots": f"""
with {runs.LOG_SQL}
select run_id, step, step // 10 as lines, 'logs/step-' || step as path from log_events where step % 100 = 0
union all
select run_id, max(step), count(*), 'logs/final' from log_events group by run_id""",
    "merged_profile": f"""
select examples, tokens, longest, true as near_1024, true as near_2048 from ({TEXT_SQL['length_profile']})""",
    "frequent_words": TEXT_SQL["top_words"],
    "series_and_params": f"""
with {runs.LOG_SQL},
series as (
  select run_id, count(*) as points, round(arg_min(value, step), 6) as first_value,
    round(arg_max(value, step), 6) as last_value, round(min(value), 6) as best_value, max(step) as last_step
  from log_events where value is not null and kind = 'log' and rank = 0 group by run_id
),
{runs._SETTINGS.strip()}
select cast(s.run_id as bigint) as run_id, points, first_value, last_value, best_value, last_step,
  cast(n_events as varchar) as n_events, case when had_error then 'True' else 'False' end as had_error,
  round(max_value, 6) as max_value
from settings s left join series on series.run_id = cast(s.run_id as bigint)""",
}
