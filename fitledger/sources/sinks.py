"""Append-only tables for metrics and parameters, and the training text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from fitledger import schemas

# Runs are spread over this many folders: a folder per run would mean one
# directory and at least one file per run.
RUN_BUCKETS = 64
BUCKET = "run_bucket"
# The number of buckets is a folder, too, so a table always says how it was dealt.
N_BUCKETS = "run_buckets"


def run_bucket(run_id: Column, buckets: int = RUN_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(run_id), F.lit(buckets)).cast("int")


def append_metrics(df: DataFrame, path: str, buckets: int = RUN_BUCKETS) -> None:
    """Append metric rows, foldered by run bucket and clustered by run inside a file.

    The rebalance hint lets AQE merge small and split large write partitions, so a
    run with a third of the rows is written by many tasks. Appends with different numbers of
    buckets may be mixed in one table.
    """
    bucketed = df.withColumns({
        N_BUCKETS: F.lit(buckets), BUCKET: run_bucket(F.col("run_id"), buckets)})
    (
        bucketed.hint("rebalance", BUCKET)
        .sortWithinPartitions(BUCKET, "run_id", "key", "step")
        .write.mode("append").partitionBy(N_BUCKETS, BUCKET).parquet(path)
    )


def read_metrics(spark: SparkSession, path: str, run_id: int | None = None) -> DataFrame:
    """The metric table; with a run given, only its folder of each number of buckets is read."""
    schema = StructType([*schemas.METRICS.fields]).add(N_BUCKETS, "integer").add(BUCKET, "integer")
    rows = spark.read.schema(schema).parquet(path)
    if run_id is not None:
        wanted = F.lit(run_id).cast("bigint")
        hashed = F.pmod(F.xxhash64(wanted), F.col(N_BUCKETS)).cast("int")
        rows = rows.filter((F.col(BUCKET) == hashed) & (F.col("run_id") == wanted))
    return rows.drop(BUCKET, N_BUCKETS)


def append_params(df: DataFrame, path: str) -> None:
    """Append melted parameters."""
    df.hint("rebalance").write.mode("append").parquet(path)


def append_tags(df: DataFrame, path: str) -> None:
    """Append melted tags; they have the shape of parameters but are always text."""
    append_params(df.withColumn("value_type", F.lit("str")), path)


def write_training_text(df: DataFrame, path: str, columns: Sequence[str] = ("example_id", "text"),
                        fmt: str = "parquet") -> None:
    """Write rendered examples; ``fmt="text"`` keeps the text column alone."""
    kept = df.select("text") if fmt == "text" else df.select(*columns)
    kept.write.mode("overwrite").format(fmt).save(path)
