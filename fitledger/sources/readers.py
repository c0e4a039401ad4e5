"""Read landed example tables and message lists given in the program."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from fitledger import schemas
from fitledger.functions import literal_messages


def read_examples(spark: SparkSession, path: str, split: str | None = "train",
                  split_column: str = "split", schema: StructType = schemas.EXAMPLES,
                  fmt: str = "parquet") -> DataFrame:
    """Rows of one split of a Parquet or JSON table, with a fixed schema.

    The split may be a folder partition (pruned) or a column (pushed to the scan).
    """
    if split is None:
        return spark.read.schema(schema).format(fmt).load(path)
    full = schema if split_column in schema.names else StructType([*schema.fields]).add(split_column, "string")
    rows = spark.read.schema(full).format(fmt).load(path).filter(F.col(split_column) == split)
    return rows.select(*schema.names)


def message_table(spark: SparkSession, rows: Sequence[tuple[str, str]]) -> DataFrame:
    """A literal message list as a table, ``role, content``."""
    return spark.createDataFrame(rows, schemas.MESSAGE)


def inline_messages(df: DataFrame, rows: Sequence[tuple[str, str]], out: str = "messages") -> DataFrame:
    """Give every row the same literal message list."""
    return df.withColumn(out, literal_messages(rows))
