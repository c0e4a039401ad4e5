"""Step times by keyed state with timers: each run has its last entry and the rows whose time has not yet passed.

Rows may come late and in any order within ``lateness``. A run's rows are held packed, beyond ``FEW_ROWS`` by slices of
time, and a timer for the end of a slice brings them out in order once the watermark has passed it. So a task holds one
slice of one run and some few rows at a time, however large the run; the rest lies in the state store. What comes later than that is dropped by Spark, which
counts it (``numRowsDroppedByWatermark``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fitledger.operators.metrics import END, LOGGING_STEPS, TIME_PER_STEP, clock_events

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LATENESS, SLICE_SECONDS, IDLE_SECONDS = "1 hour", 3_600, 30 * 86_400
OUT = f"run_id bigint, event_id bigint, {TIME_PER_STEP} double"
# Waiting rows of a run that are kept in its value, some 17 bytes each.
FEW_ROWS = 1_024
_ROW = np.dtype([("micros", "<i8"), ("event_id", "<i8"), ("ends", "i1")])


class RunClock(StatefulProcessor):
    """Seconds per step since a run's last entry; an end event, or a long silence, closes the run.

    A run has one value, which is read and written once a call: its last entry, the rows that wait while they are few, and
    otherwise the slices that hold them with the number of their packs. Its next timer is the end of its first slice.
    """

    def __init__(self, logging_steps: int, slice_seconds: int, idle_seconds: int):
        self.steps, self.slice, self.idle = 1e6 * max(logging_steps, 1), 1000 * slice_seconds, 1000 * idle_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # few: rows in any order; packs: (slice, number of packs) of all others; due: the timer that is set.
        self.run = handle.getValueState("run", "last bigint, due bigint, few binary, packs binary")
        self.rows = handle.getMapState("rows", "slice bigint, pack int", "body binary")

    def _read(self) -> tuple[int | None, int | None, np.ndarray, dict[int, int]]:
        found = self.run.get()
        if found is None:
            return None, None, np.empty(0, _ROW), {}
        last, due, few, packs = found
        return last, due, np.frombuffer(few, _ROW), dict(np.frombuffer(packs, "<i8").reshape(-1, 2).tolist())

    def _write(self, last: int | None, due: int | None, few: np.ndarray, packs: dict[int, int]) -> None:
        """Keep the run, with a timer for what comes first: the end of a slice, or else the end of its silence."""
        starts = [*packs, *([int(few["micros"].min()) // (1000 * self.slice)] if len(few) else [])]
        if not starts and last is None:
            self.run.clear()
            return
        next_due = (min(starts) + 1) * self.slice if starts else last // 1000 + self.idle + 1
        if due is None or next_due != due:
            self.handle.registerTimer(next_due)
        self.run.update((last, next_due, few.tobytes(), np.array([*packs.items()], "<i8").tobytes()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, due, few, packs = self._read()
        for frame in rows:
            packed = np.empty(len(frame), _ROW)
            packed["micros"], packed["event_id"] = frame["micros"].to_numpy(), frame["event_id"].to_numpy()
            packed["ends"] = frame["ends"].to_numpy()
            few = np.concatenate([few, packed])
            if len(few) > FEW_ROWS:
                slices = few["micros"] // (1000 * self.slice)
                for at in np.unique(slices).tolist():
                    self.rows.updateValue((at, packs.get(at, 0)), (few[slices == at].tobytes(),))
                    packs[at] = packs.get(at, 0) + 1
                few = few[:0]
        self._write(last, due, few, packs)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, due, few, packs = self._read()
        expired, now = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        if due is None or expired != due:       # a timer that an earlier one has taken the place of
            return
        ends = (few["micros"] // (1000 * self.slice) + 1) * self.slice
        passed = (ends <= expired) | (ends < now)
        if not packs:
            groups = [(few[passed], 0, 0)] if passed.any() else []
        else:       # large: all slices that have passed, one after the other
            starts = sorted({*packs, *(ends[passed] // self.slice - 1).tolist()})
            starts = [at for at in starts if (at + 1) * self.slice <= expired or (at + 1) * self.slice < now]
            groups = [(few[ends == (at + 1) * self.slice], at, packs.pop(at, 0)) for at in starts]
        few = few[~passed]
        for rows, at, n in groups:
            held = [rows]
            for k in range(n):
                held.append(np.frombuffer(self.rows.getValue((at, k))[0], _ROW))
                self.rows.removeKey((at, k))
            times, last = self._pass(key[0], np.concatenate(held), last)
            if times is not None:
                yield times
        if last is not None and not packs and not len(few) and last // 1000 + self.idle < max(now, expired):
            last = None
        self._write(last, due, few, packs)

    def _pass(self, run_id: int, rows: np.ndarray, last: int | None) -> tuple[pd.DataFrame | None, int | None]:
        """The step times of one or more slices, and the last entry for the next one."""
        rows = rows[np.lexsort((rows["event_id"], rows["micros"]))]
        before = np.concatenate([[last or 0], rows["micros"][:-1]])
        # Fresh after an end, after a silence, and at the very start.
        fresh = np.concatenate([[last is None], rows["ends"][:-1] == 1]) | (rows["micros"] - before > 1000 * self.idle)
        timed = ~fresh & (rows["ends"] == 0)
        last = None if rows["ends"][-1] else int(rows["micros"][-1])
        if not timed.any():
            return None, last
        return pd.DataFrame({"run_id": run_id, "event_id": rows["event_id"][timed],
                             TIME_PER_STEP: (rows["micros"][timed] - before[timed]) / self.steps}), last

    def close(self) -> None:
        pass


def stream_run_times(stream: DataFrame, logging_steps: int = LOGGING_STEPS, lateness: str = LATENESS,
                     slice_seconds: int = SLICE_SECONDS, idle_seconds: int = IDLE_SECONDS) -> DataFrame:
    """``run_id, event_id, time_per_step`` of log entries as they come, once their time has passed by ``lateness``.

    The same times as :func:`fitledger.operators.metrics.time_per_step`, whatever the order of arrival, but for two
    cases: a run that says nothing for ``idle_seconds`` is closed, and what follows starts afresh; and entries later
    than ``lateness`` are dropped. Entries of the last ``lateness`` of a stream come out when more arrives.
    Uses the RocksDB state store, which is set for the session.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    clocked = clock_events(stream).select(
        "run_id", "event_id", "ts", F.unix_micros("ts").alias("micros"), (F.col("kind") == END).cast("int").alias("ends"))
    clock = RunClock(logging_steps, slice_seconds, idle_seconds)
    return clocked.withWatermark("ts", lateness).groupBy("run_id").transformWithStateInPandas(
        clock, OUT, "Append", "EventTime")
