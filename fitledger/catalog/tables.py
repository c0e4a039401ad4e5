"""The tables the registered queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fitledger import schemas
from fitledger.operators.examples import conversation_examples
from fitledger.session import scratch_path
from fitledger.sources.derived import log_entries, log_events
from fitledger.sources.log_table import read_logs, store_logs

SCHEMAS = {
    "conversations": schemas.CONVERSATIONS,
    "documents": schemas.DOCUMENTS,
    "events": schemas.EVENTS,
}


def path_of(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(path_of(sf_dir, name))


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_examples(table(spark, sf_dir, "conversations"))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log without steps, which costs nothing to derive."""
    return log_entries(table(spark, sf_dir, "events"))


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_events(table(spark, sf_dir, "events"))


def stored(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Log rows as a log table: parsed once, then read as VARIANT."""
    path = scratch_path(spark, "logs")
    store_logs(rows, path)
    return read_logs(spark, path)
