"""Log files as streams of lines: accepted rows, rejected lines and their counts, each micro-batch in one pass."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from fitledger import schemas
from fitledger.sources.log_table import parse_lines, read_logs, write_log_rows
from fitledger.streaming.logs import MAX_BYTES, file_pattern
from fitledger.streaming.sinks import Sink, read_sink, table_sink

COUNTS = "rows long, rejected long"


def read_line_stream(spark: SparkSession, path: str, max_bytes_per_trigger: int = MAX_BYTES) -> DataFrame:
    """``value, file``: the lines of text files as they land in a folder, or of one file.

    A file is read once, when it is first seen: a running log has to be rotated into the folder. What was half-written then
    is a line like others, and is rejected if it is broken.
    """
    lines = spark.readStream.format("text").option("maxBytesPerTrigger", max_bytes_per_trigger).load(file_pattern(path))
    return lines.select("value", F.col("_metadata.file_path").alias("file"))


def line_sink(path: str, stream_name: str) -> Sink:
    """Parse each micro-batch of lines into a log table, with the counts of each beside it.

    One pass writes accepted and rejected lines and counts them. A micro-batch that is run again after a failure replaces its
    own folders, so no line is lost or doubled.
    """
    rows, count = f"{path}/rows/stream={quote(stream_name, safe='')}", table_sink(f"{path}/counts", stream_name)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        found = write_log_rows(parse_lines(batch), f"{rows}/batch_id={batch_id}", "overwrite")
        count(batch.sparkSession.createDataFrame([(found["rows"], found["rejected"])], COUNTS), batch_id)

    return deliver


def read_lines(spark: SparkSession, path: str, accepted: bool = True) -> DataFrame:
    """The rows that :func:`line_sink` has accepted, or rejected; none where nothing has arrived yet."""
    try:
        return read_logs(spark, f"{path}/rows", accepted, "/stream=*/batch_id=*")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], schemas.LOG_ROWS)


def read_line_counts(spark: SparkSession, path: str) -> DataFrame:
    """``rows, rejected`` of each micro-batch."""
    schema = spark.createDataFrame([], COUNTS).schema
    return read_sink(spark, f"{path}/counts", schema)
