"""Write one stream to several places."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StructType

from fitledger.operators.metrics import END, LOGGING_STEPS, TIME_PER_STEP, clock_events, step_times
from fitledger.operators.ordered import ROWS_PER_SLOT

STEP_TIMES = StructType().add("run_id", LongType()).add("event_id", LongType()).add(TIME_PER_STEP, DoubleType())
Sink = Callable[[DataFrame, int], None]


def table_sink(path: str, stream_name: str, mode: str = "a") -> Sink:
    """A Parquet table with a folder per stream and micro-batch.

    A micro-batch that is run again after a failure replaces its own folder, so
    nothing is lost or doubled. Mode ``w`` clears the table at the first
    micro-batch, mode ``a`` keeps what other streams wrote.
    """
    if mode not in ("a", "w"):
        raise ValueError("mode must be 'a' or 'w'")

    own = f"{path}/stream={quote(stream_name, safe='')}"

    def write(batch: DataFrame, batch_id: int) -> None:
        if mode == "w" and batch_id == 0:
            # Static overwriting of the whole table, which leaves it empty.
            batch.limit(0).write.mode("overwrite").parquet(path)
        # A micro-batch without rows leaves an empty file that has the schema.
        batch.write.mode("overwrite").parquet(f"{own}/batch_id={batch_id}")

    return write


def read_sink(spark: SparkSession, path: str, schema: StructType, stream_name: str | None = None) -> DataFrame:
    """What a :func:`table_sink` has written; no rows where nothing has arrived yet."""
    columns = [f.name for f in schema]
    full = StructType([*schema.fields]).add("stream", "string").add("batch_id", "long")
    try:
        rows = spark.read.schema(full).option("basePath", path).parquet(f"{path}/stream=*")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], schema)
    if stream_name is not None:
        rows = rows.filter(F.col("stream") == stream_name)
    return rows.select(*columns)


def through(transform: Callable[[DataFrame], DataFrame], sink: Sink) -> Sink:
    """A sink that receives the transformed micro-batch: good rows to one table, rejects to another."""

    def deliver(batch: DataFrame, batch_id: int) -> None:
        sink(transform(batch), batch_id)

    return deliver


def step_time_sink(path: str, carry_path: str, stream_name: str,
                   logging_steps: int = LOGGING_STEPS,
                   rows_per_slot: int = ROWS_PER_SLOT) -> Sink:
    """Step times of log entries, for streams in which one run may hold much of a micro-batch.

    The micro-batch goes through the batch operator, which cuts a large run into
    slots. Each run's last entry is carried to the next micro-batch in a small
    table of one row per running run. It is kept in two folders by turns, so a
    micro-batch that is run again finds what it read the first time.
    """
    write = table_sink(path, stream_name)
    columns = ["run_id", "event_id", "ts", "kind"]

    def deliver(batch: DataFrame, batch_id: int) -> None:
        entries = clock_events(batch).select(*columns, F.lit(True).alias("is_new"))
        if batch_id > 0:
            carried = batch.sparkSession.read.schema(entries.schema).parquet(
                f"{carry_path}/{(batch_id - 1) % 2}")
            entries = carried.unionByName(entries)
        timed = step_times(entries, logging_steps, rows_per_slot)
        write(timed.filter("is_new").select("run_id", "event_id", TIME_PER_STEP), batch_id)
        last = entries.groupBy("run_id").agg(
            F.max_by(F.struct("event_id", "ts", "kind"), F.struct("ts", "event_id")).alias("last"))
        (
            last.select("run_id", "last.*").filter(F.col("kind") != END)
            .withColumn("is_new", F.lit(False))
            .write.mode("overwrite").parquet(f"{carry_path}/{batch_id % 2}")
        )

    return deliver


def stream_time_per_step(stream: DataFrame, place: str, stream_name: str = "times",
                         logging_steps: int = LOGGING_STEPS, rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """``run_id, event_id, time_per_step`` of all log entries that have landed, kept below ``place``.

    Events are taken to land in time order from one micro-batch to the next; each call goes on where the last ended.
    """
    drain(stream, [step_time_sink(f"{place}/times", f"{place}/carry", stream_name, logging_steps, rows_per_slot)],
          f"{place}/progress")
    return read_sink(stream.sparkSession, f"{place}/times", STEP_TIMES, stream_name)


def tee_sink(stream: DataFrame, sinks: Sequence[Sink], checkpoint: str,
             available_now: bool = False) -> StreamingQuery:
    """Send every micro-batch to all sinks; it is computed once."""

    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def drain(stream: DataFrame, sinks: Sequence[Sink], checkpoint: str) -> None:
    """Process all that has landed, then stop."""
    tee_sink(stream, sinks, checkpoint, available_now=True).awaitTermination()
