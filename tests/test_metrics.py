"""Log maps to metric rows, step times, summaries, and the tables they are kept in."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fitledger import schemas
from fitledger.catalog import tables
from fitledger.operators import metrics as m
from fitledger.operators import registry as reg
from fitledger.sources import sinks
from fitledger.sources.derived import log_events, run_settings
from conftest import MEDIUM, SMALL

START = dt.datetime(2024, 1, 1)


def log_frame(spark, texts, kind="log"):
    rows = [(1, i, START + dt.timedelta(seconds=i), 10 * (i + 1), kind, 0, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, schemas.LOG_EVENTS)


def points(df):
    return sorted((r["event_id"], r["key"], r["value"]) for r in df.collect())


UNIT = [
    '{"loss":2.5,"n":3}', '{"b":true}', '{"s":"3"}', '{"z":null}', "{}", None, "{bad",
    '{"a":[1],"o":{"x":1}}', "[1,2]", "3", '{"big":1e300,"neg":-0.125}',
]


def test_only_numbers_are_kept(spark):
    assert points(m.metrics_long(log_frame(spark, UNIT))) == [
        (0, "loss", 2.5), (0, "n", 3.0), (1, "b", 1.0), (10, "big", 1e300), (10, "neg", -0.125),
    ]


def test_python_floats_survive(spark):
    values = [0.1, 1 / 3, 2e-4, 123456.789, 1e-300, 12345678901234567]
    got = points(m.metrics_long(log_frame(spark, [json.dumps({"v": v}) for v in values])))
    assert [v for _, _, v in got] == [float(v) for v in values]


def test_malformed_rows_are_kept_apart(spark):
    df = log_frame(spark, UNIT)
    assert [r["event_id"] for r in m.malformed_logs(df).collect()] == [6]


def test_loggable(spark):
    df = log_frame(spark, UNIT)
    assert sorted(r["event_id"] for r in m.loggable(df).collect()) == [0, 1, 2, 3, 7, 10]
    assert m.loggable(df.withColumn("run_id", F.lit(None).cast("bigint"))).isEmpty()


def test_eval_prefix_is_added_blindly(spark):
    df = log_frame(spark, ['{"eval_loss":1}', '{"loss":2}'], "evaluate")
    assert points(m.eval_metrics(df)) == [(0, "eval_eval_loss", 1.0), (1, "eval_loss", 2.0)]
    assert m.eval_metrics(log_frame(spark, ['{"loss":2}'])).isEmpty()
    assert points(m.hook_metrics(df)) == points(m.eval_metrics(df))


def test_final_metrics_have_step_zero(spark):
    df = log_frame(spark, ['{"loss":3}', '{"loss":1,"runtime":9}'])
    assert sorted((r["key"], r["value"], r["step"]) for r in m.final_metrics(df).collect()) == [
        ("loss", 1.0, 0), ("runtime", 9.0, 0)]


def test_a_run_with_one_event_has_no_step_time(spark):
    assert m.time_per_step(log_frame(spark, ['{"a":1}'])).isEmpty()


def test_step_time_and_its_divisor(spark):
    df = log_frame(spark, ['{"a":1}'] * 3)
    assert [r["time_per_step"] for r in m.time_per_step(df, 10).collect()] == [0.1, 0.1]
    assert [r["time_per_step"] for r in m.time_per_step(df, 0).collect()] == [1.0, 1.0]


def test_end_event_starts_afresh(spark):
    df = log_frame(spark, ['{"a":1}'] * 6).withColumn("kind", F.when(F.col("event_id") == 2, "end").otherwise("log"))
    assert sorted(r["event_id"] for r in m.time_per_step(df).collect()) == [1, 4, 5]


def test_one_huge_run(spark):
    """A third of all rows in one run: cut into slots, with the same result."""
    events = tables.table(spark, SMALL, "events")
    skewed = events.withColumn("user_id", F.when(F.col("event_id") < 400, 0).otherwise(F.col("user_id")))
    whole, cut = log_events(skewed), log_events(skewed, rows_per_slot=25)
    assert sorted(whole.collect()) == sorted(cut.select(*whole.columns).collect())
    a = m.time_per_step(whole).select("event_id", "time_per_step")
    b = m.time_per_step(whole, rows_per_slot=25).select("event_id", "time_per_step")
    assert sorted(a.collect()) == sorted(b.collect())
    long = m.metrics_long(whole)
    h1 = m.metric_history(long).select("event_id", "key", "seq")
    h2 = m.metric_history(long, rows_per_slot=25).select("event_id", "key", "seq")
    assert sorted(h1.collect()) == sorted(h2.collect())


def test_step_times_of_the_event_table(spark):
    rows = m.time_per_step(tables.logs(spark, MEDIUM))
    assert rows.count() == 7833


def test_history_blocks_are_bounded_and_whole(spark):
    history = m.metric_history(m.metrics_long(tables.logs(spark, SMALL)))
    blocks = m.history_blocks(history, 7)
    assert blocks.agg(F.max(F.size("points"))).first()[0] == 7
    back = blocks.select("run_id", "key", F.explode("points").alias("p")).select("run_id", "key", "p.*")
    assert back.exceptAll(history.select("run_id", "key", "step", "value")).isEmpty()
    assert back.count() == history.count()


def test_metrics_table(spark, tmp_path):
    path = str(tmp_path / "metrics")
    long = m.metrics_long(tables.logs(spark, SMALL))
    sinks.append_metrics(long, path)
    sinks.append_metrics(long, path)
    assert sinks.read_metrics(spark, path).count() == 2 * long.count()
    one = sinks.read_metrics(spark, path, run_id=3)
    assert one.count() == 2 * long.filter("run_id = 3").count() > 0
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(run_bucket" in plan and "PushedFilters: [IsNotNull(run_id)" in plan


def test_metrics_table_of_several_bucket_counts(spark, tmp_path):
    path = str(tmp_path / "metrics")
    long = m.metrics_long(tables.logs(spark, SMALL)).cache()
    for buckets in (256, 3, 64):
        sinks.append_metrics(long, path, buckets)
    for run in range(0, 15):
        assert sinks.read_metrics(spark, path, run_id=run).count() == 3 * long.filter(f"run_id = {run}").count()


EVENTS = [      # seconds, kind, rank, logs: all of run 1
    (0, "log", 0, '{"loss":3}'), (0, "log", 1, '{"loss":9}'), (1, "evaluate", 0, '{"loss":0}'), (2, "log", 0, "{}"),
    (None, "log", 0, '{"loss":8}'), (4, "log", 0, '{"loss":2}'), (4, "log", 2, '{"loss":9}'), (5, "end", 0, None),
    (7, "log", 0, '{"loss":1}'), (8, "log", 0, '{"loss":5}'), (8, "log", 3, '{"loss":7}'), (9, "end", 0, "{}"),
]


@pytest.fixture
def mixed(spark):
    rows = [(1, i, None if s is None else START + dt.timedelta(seconds=s), 10 * i, kind, rank, logs)
            for i, (s, kind, rank, logs) in enumerate(EVENTS)]
    return spark.createDataFrame(rows, schemas.LOG_EVENTS)


def test_log_hook_and_what_is_not_logged(mixed):
    got = points(m.log_hook(mixed))
    assert got == [(0, "loss", 3.0), (4, "loss", 8.0), (5, "loss", 2.0), (5, "time_per_step", 0.4), (8, "loss", 1.0),
                   (9, "loss", 5.0), (9, "time_per_step", 0.1)]
    assert points(m.recorded_metrics(mixed)) == sorted([*got, (2, "eval_loss", 0.0)])
    row = m.run_summary(m.recorded_metrics(mixed), "loss").first()
    assert row.asDict() == {"run_id": 1, "points": 5, "first_value": 3.0, "last_value": 5.0, "best_value": 1.0, "last_step": 90}


def test_final_metrics_skip_the_end_event(mixed):
    assert points(m.final_metrics(m.lead_rank_only(mixed))) == [(9, "loss", 5.0)]


def test_session_zone_changes_no_event_time(spark):
    before = [tuple(r) for r in tables.logs(spark, SMALL).selectExpr("event_id", "unix_micros(ts)").collect()]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        after = [tuple(r) for r in tables.logs(spark, SMALL).selectExpr("event_id", "unix_micros(ts)").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert sorted(before) == sorted(after)


def test_melt_params_and_side_by_side(spark):
    df = spark.createDataFrame(
        [(1, 16, 0.05, True, "cosine"), (2, 8, None, False, None)],
        "run_id int, lora_r int, lora_dropout double, packing boolean, scheduler string")
    melted = reg.melt_params(df, "run_id", ["lora_r", "lora_dropout", "packing", "scheduler"])
    assert melted.columns == schemas.PARAMS.names
    assert sorted(map(tuple, melted.collect())) == [
        ("1", "lora_dropout", "0.05", "float"), ("1", "lora_r", "16", "int"),
        ("1", "packing", "True", "bool"), ("1", "scheduler", "cosine", "str"),
        ("2", "lora_r", "8", "int"), ("2", "packing", "False", "bool"),
    ]
    wide = m.params_side_by_side(melted, ["lora_r", "scheduler"])
    assert sorted(map(tuple, wide.collect()), key=repr) == [("1", "16", "cosine"), ("2", "8", None)]


def test_settings_are_typed(spark):
    df = run_settings(tables.logs(spark, SMALL))
    assert dict(df.dtypes)["had_error"] == "boolean"
    assert df.count() == 15


@pytest.mark.parametrize("n", [1, 3])
def test_filters(spark, n):
    df = log_frame(spark, ['{"a":1}'] * 12)
    assert m.every_n_steps(df, 10 * n).count() == 12 // n
    assert m.lead_rank_only(df.withColumn("rank", F.lit(n))).isEmpty()
