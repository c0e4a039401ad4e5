"""Log files read line by line, and log tables that are parsed once."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fitledger import schemas
from fitledger.catalog import tables
from fitledger.operators import metrics as m
from fitledger.sources.log_table import log_rows, parse_lines, read_logs, store_logs, write_log_rows
from fitledger.streaming import drain, line_sink, read_line_counts, read_line_stream, read_lines, table_sink
from conftest import SMALL

LINES = [
    ('{"run_id":1,"event_id":7,"ts":"2024-01-02 03:04:05","step":10,"kind":"log","rank":0,"logs":{"loss":2.5,"ok":true}}', None),
    ('{"run_id":1}', None), ('{"run_id":"2","logs":"text"}', None), ('  {"run_id":3,"logs":{}}  ', None),
    ('{"run_id":1,"event_id":7,"lo', "not JSON"), ("prose = here", "not JSON"), ('{"run_id":1} trailing', "not JSON"),
    ("[1, 2]", "not an object"), ("17", "not an object"), ("null", "not an object"), ('{"event_id":1}', "no run"), ('{"run_id":"x"}', "no run"),
    ("{}", "no run"), ("", "empty"), ("   ", "empty"), ("é€😀", "not JSON"), ("x" * 300_000, "not JSON"),
]


def test_lines_are_accepted_or_rejected(spark, tmp_path):
    df = spark.createDataFrame([(line,) for line, _ in LINES] * 2, "value string")
    found = write_log_rows(parse_lines(df), str(tmp_path / "t"))
    assert found == {"rows": 2 * len(LINES), "rejected": 2 * sum(r is not None for _, r in LINES)}
    good, bad = (read_logs(spark, str(tmp_path / "t"), accepted=a) for a in (True, False))
    assert sorted((r.line, r.reason) for r in bad.collect()) == sorted([x for x in LINES if x[1]] * 2)
    assert good.count() == 2 * sum(r is None for _, r in LINES)
    row = good.filter("event_id = 7").first()
    assert (row.run_id, row.step, row.kind, row["rank"], row.line) == (1, 10, "log", 0, None)
    assert row.ts == dt.datetime(2024, 1, 2, 3, 4, 5) and row.entry.toPython() == {"loss": Decimal("2.5"), "ok": True}
    assert {r.run_id for r in good.collect()} == {1, 2, 3}
    empty = write_log_rows(parse_lines(df.limit(0)), str(tmp_path / "none"))
    assert empty == {"rows": 0, "rejected": 0}


def test_a_pass_writes_and_counts(spark, tmp_path):
    """One scan of the input for both folders and the counts, and one parse of each row."""
    rows = tables.logs(spark, SMALL).withColumn("logs", F.when(F.col("event_id") % 5 == 0, "{half").otherwise(F.col("logs")))
    source = str(tmp_path / "in")
    rows.write.parquet(source)
    stored = log_rows(spark.read.schema(schemas.LOG_EVENTS).parquet(source))
    plan = stored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") == 1
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    found = store_logs(spark.read.schema(schemas.LOG_EVENTS).parquet(source), str(tmp_path / "t"))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) - len(before) == 1
    assert found == {"rows": 1000, "rejected": 200}


def test_operators_read_the_stored_entry(spark, tmp_path):
    text = tables.logs(spark, SMALL)
    store_logs(text, str(tmp_path / "t"))
    table = read_logs(spark, str(tmp_path / "t"))

    def same(operator, *columns):
        a, b = (sorted(map(tuple, operator(df).select(*columns).collect()), key=repr) for df in (text, table))
        assert a == b and a

    same(m.metrics_long, "run_id", "event_id", "key", "value", "step", "log_time")
    same(m.eval_metrics, "event_id", "key", "value")
    same(m.final_metrics, "run_id", "event_id", "key", "value", "step")
    same(m.loggable, "run_id", "event_id")
    same(m.time_per_step, "run_id", "event_id", "time_per_step")
    same(m.recorded_metrics, "run_id", "event_id", "key", "value")
    for operator in (m.metrics_long, m.final_metrics, m.loggable, m.time_per_step, m.timing_metrics, m.log_hook):
        plan = operator(table)._jdf.queryExecution().toString()
        assert "parse_json" not in plan and "parseJson" not in plan
    assert m.final_metrics(table)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def land(path, lines, name):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(lines), encoding="utf-8")       # the last line has no end


def test_lines_survive_failures_and_restarts(spark, tmp_path):
    """Files land between runs; a micro-batch fails after writing. Each line is in one table, once."""
    source, place = tmp_path / "in", str(tmp_path / "out")
    texts = [line for line, _ in LINES if line.strip() and "\n" not in line]
    sink, failed = line_sink(place, "a/b"), set()

    def unreliable(batch, batch_id):
        sink(batch, batch_id)
        if batch_id % 2 == 0 and batch_id not in failed:
            failed.add(batch_id)
            raise RuntimeError("lost after writing")

    n = 0
    for part in range(3):
        land(source, texts, f"{part}.log")
        n += len(texts)
        for _ in range(2):
            try:
                drain(read_line_stream(spark, str(source), max_bytes_per_trigger=100), [unreliable], f"{place}/progress")
            except Exception as error:
                assert "lost after writing" in str(error)
        good, bad = read_lines(spark, place), read_lines(spark, place, accepted=False)
        assert good.count() + bad.count() == n
        counts = read_line_counts(spark, place).agg(F.sum("rows"), F.sum("rejected")).first()
        assert tuple(counts) == (n, bad.count())
    assert failed
    assert {r.file.rsplit("/", 1)[1] for r in bad.select("file").distinct().collect()} == {"0.log", "1.log", "2.log"}
    reasons = {r.reason: r["count"] for r in bad.groupBy("reason").count().collect()}
    assert reasons == {k: 3 * sum(r == k and t.strip() != "" for t, r in LINES) for k in ("not JSON", "not an object", "no run")}


def test_nothing_has_arrived(spark, tmp_path):
    assert read_lines(spark, str(tmp_path / "nowhere")).columns == schemas.LOG_ROWS.names
    assert read_lines(spark, str(tmp_path / "nowhere"), accepted=False).isEmpty()
    assert read_line_counts(spark, str(tmp_path / "nowhere")).isEmpty()
    source = tmp_path / "in"
    land(source, [""], "empty.log")
    drain(read_line_stream(spark, str(source)), [line_sink(str(tmp_path / "out"), "s")], str(tmp_path / "progress"))
    assert read_lines(spark, str(tmp_path / "out")).count() == 0


def test_lines_go_to_a_tee(spark, tmp_path):
    source = tmp_path / "in"
    land(source, ["{bad", '{"run_id":4}'], "x.log")
    drain(read_line_stream(spark, str(source)),
          [line_sink(str(tmp_path / "rows"), "s"), table_sink(str(tmp_path / "raw"), "s")], str(tmp_path / "progress"))
    assert sorted(r.value for r in spark.read.parquet(str(tmp_path / "raw")).collect()) == ['{"run_id":4}', "{bad"]
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 2
    assert read_lines(spark, str(tmp_path / "rows")).first().run_id == 4


EVENTS = [(1, 5, None, 1.0), (1, 3, None, 2.0), (2, 4, 10, 3.0), (2, 9, 10, 4.0), (2, 1, 20, 5.0), (2, 2, None, 6.0), (3, None, 0, 7.0),
          (3, 1, 0, 8.0), (4, 1, -(1 << 63), 9.0), (4, 1, (1 << 63) - 1, 10.0), (None, 1, 1, 11.0), (None, 2, 1, 12.0)]


def test_summary_of_odd_steps(spark):
    """Points without a step come first; ties by event; a run without an id is one run."""
    rows = [(r, e, "loss", v, s, None) for r, e, s, v in EVENTS] + [(1, 1, "other", 0.0, 1, None)]
    got = {r.run_id: tuple(r)[1:] for r in m.run_summary(spark.createDataFrame(rows, schemas.METRICS), "loss").collect()}
    assert got == {1: (2, 2.0, 1.0, 1.0, None), 2: (4, 6.0, 5.0, 3.0, 20), 3: (2, 7.0, 8.0, 7.0, 0),
                   4: (2, 9.0, 10.0, 9.0, (1 << 63) - 1), None: (2, 11.0, 12.0, 11.0, 1)}


def test_summary_is_one_hash_aggregate(spark):
    df = spark.createDataFrame([], schemas.METRICS)
    plan = m.run_summary(df, "loss")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Join" not in plan and plan.count("HashAggregate") >= 2


def test_final_metrics_of_odd_rows(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [(1, 1, at, 10, "log", 0, '{"a":1}'), (1, 2, at, 20, "log", 0, '{"a":2}'), (1, 3, None, 30, "log", 0, '{"a":3}'),
            (1, 4, at, 40, "log", 0, "{}"), (1, 5, at, 40, "log", 0, "{bad"), (2, 1, None, 10, "log", 0, '{"a":5}'),
            (2, 2, None, 10, "log", 0, '{"a":6}'), (None, 1, at, 1, "log", 0, '{"a":7}')]
    got = m.final_metrics(spark.createDataFrame(rows, schemas.LOG_EVENTS))
    assert sorted((r.run_id, r.value, r.step) for r in got.collect()) == [(1, 2.0, 0), (2, 6.0, 0)]
    assert "WindowGroupLimit" in got._jdf.queryExecution().toString()


@pytest.mark.parametrize("rows_per_slot", [3, 1_000_000])
def test_snapshots_of_logs(spark, rows_per_slot):
    rows = [(1, i, None, s, "log", 0, None) for i, s in enumerate([0, 50, 100, 100, 150, 200, 250])]
    rows += [(2, 1, None, None, "log", 0, None), (None, 1, None, 100, "log", 0, None), (3, 1, None, 30, "log", 0, None)]
    got = m.log_snapshots(spark.createDataFrame(rows, schemas.LOG_EVENTS), rows_per_slot=rows_per_slot)
    assert sorted(map(tuple, got.collect())) == [
        (1, 100, 4, "logs/step-100"), (1, 200, 6, "logs/step-200"), (1, 250, 7, "logs/final"), (3, 30, 1, "logs/final")]
