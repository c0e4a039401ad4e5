"""Uploads and checkpoint reports as streams with bounded state."""

import datetime as dt

import pytest

from fitledger import schemas
from fitledger.streaming import drain, follow_uploads, read_log_stream, read_sink, stream_checkpoint_events, table_sink, tee_sink

START = dt.datetime(2024, 1, 1)
STARTED = "run_id bigint, path string, started_at timestamp"
FINISHED = "run_id bigint, path string, finished_at timestamp"


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def land(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def follow(spark, place):
    source = [read_log_stream(spark, f"{place}/{name}", spark.createDataFrame([], schema).schema)
              for name, schema in (("started", STARTED), ("finished", FINISHED))]
    found = follow_uploads(*source)
    query = tee_sink(found, [table_sink(f"{place}/out", "s")], f"{place}/progress", available_now=True)
    query.awaitTermination()
    rows = read_sink(spark, f"{place}/out", found.schema, "s").collect()
    state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    return sorted(((r.run_id, r.path, r.finished_at is None) for r in rows), key=str), state[-1] if state else None


def test_pending_uploads_come_out_when_time_has_passed(spark, tmp_path):
    place = str(tmp_path)
    land(spark, [(1, "a", at(0)), (1, "b", at(1)), (2, "a", at(2)), (3, "x", at(3)), (4, "late end", at(5)), (5, None, at(5)),
                 (None, "n", at(5)), (6, "no time", None)], STARTED, f"{place}/started")
    land(spark, [(1, "a", at(10)), (2, "a", at(30)), (9, "never started", at(4)), (3, "x", at(1)), (4, "late end", at(66))],
         FINISHED, f"{place}/finished")
    got, _ = follow(spark, place)
    assert got == [(1, "a", False), (2, "a", False)]            # nothing is given up before its time
    # Half an hour later a restart finds more; two hours later the rest is pending.
    land(spark, [(7, "c", at(40))], STARTED, f"{place}/started")
    land(spark, [(1, "b", at(45))], FINISHED, f"{place}/finished")
    got, _ = follow(spark, place)
    assert got == [(1, "a", False), (1, "b", False), (2, "a", False)]
    land(spark, [(8, "end", at(400))], STARTED, f"{place}/started")
    land(spark, [(8, "end", at(400))], FINISHED, f"{place}/finished")
    got, kept = follow(spark, place)
    assert {g for g in got if g[2]} == {
        (3, "x", True), (4, "late end", True), (7, "c", True), (5, None, True), (None, "n", True)}
    assert [g for g in got if not g[2]] == [(1, "a", False), (1, "b", False), (2, "a", False), (8, "end", False)]
    assert kept <= 2                                             # the last start and its end


def reports(spark, steps, path, minutes=0):
    rows = [(run, i, START + dt.timedelta(minutes=minutes + s / 100, seconds=rank), s, "log", rank, None)
            for i, (run, s) in enumerate(steps) for rank in range(4)]
    land(spark, rows, schemas.LOG_EVENTS, path)


def test_four_ranks_are_one_checkpoint_and_are_forgotten(spark, tmp_path):
    source, place = str(tmp_path / "in"), str(tmp_path / "run")
    state = []

    def run():
        due = stream_checkpoint_events(read_log_stream(spark, source), lateness="10 minutes")
        query = tee_sink(due, [table_sink(f"{place}/out", "s")], f"{place}/progress", available_now=True)
        query.awaitTermination()
        state.append([p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1])
        return sorted((r.run_id, r.step) for r in read_sink(spark, f"{place}/out", due.schema, "s").collect())

    first = [(run_id, s) for run_id in range(30) for s in (200, 400, 600)]
    reports(spark, first, source)
    assert run() == sorted(first)
    reports(spark, first, source)                                # reported again, within the time
    assert run() == sorted(first)
    reports(spark, [(1, 800)], source, minutes=120)
    assert run() == sorted([*first, (1, 800)])
    assert state[0] >= 90 and state[-1] <= 2


def test_reports_of_odd_rows(spark, tmp_path):
    source, place = str(tmp_path / "in"), str(tmp_path / "run")
    rows = [(None, 1, START, 200, "log", 0, None), (1, 1, None, 200, "log", 0, None), (1, 2, START, None, "log", 0, None),
            (1, 3, START, 0, "log", 0, None), (1, 4, START, 400, "log", 0, "{bad"), (None, 5, START, 200, "log", 1, None)]
    land(spark, rows, schemas.LOG_EVENTS, source)
    due = stream_checkpoint_events(read_log_stream(spark, source))
    drain(due, [table_sink(f"{place}/out", "s")], f"{place}/progress")
    got = [(r.run_id, r.step) for r in read_sink(spark, f"{place}/out", due.schema, "s").collect()]
    assert sorted(got, key=str) == [(1, 400), (None, 200)]


@pytest.mark.parametrize("existing", [[], [(1, "checkpoint-200")]])
def test_only_folders_that_are_there(spark, tmp_path, existing):
    source, place = str(tmp_path / "in"), str(tmp_path / "run")
    reports(spark, [(1, 200), (1, 400)], source)
    there = spark.createDataFrame(existing, "run_id bigint, path string")
    due = stream_checkpoint_events(read_log_stream(spark, source), existing=there)
    drain(due, [table_sink(f"{place}/out", "s")], f"{place}/progress")
    assert read_sink(spark, f"{place}/out", due.schema, "s").count() == len(existing)
