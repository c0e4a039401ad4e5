"""Metrics and parameters as tables bucketed by run, which meet without a shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from fitledger.operators.metrics import params_side_by_side, run_summary

BUCKETS = 64


def save_by_run(df: DataFrame, path: str, name: str | None = None, buckets: int = BUCKETS) -> str:
    """Save rows as a table at ``path``, bucketed and sorted by ``run_id`` (a long); returns its name.

    The rows are dealt by run before, so that each bucket is one file. A run is one task of what reads the table: for
    points of runs that hold a large part of all, keep :func:`fitledger.sources.sinks.append_metrics`, whose summaries
    add up per task first.
    """
    table = name or f"by_run_{uuid.uuid4().hex}"
    rows = df.withColumn("run_id", F.col("run_id").cast("bigint"))
    (rows.repartition(buckets, "run_id").write.bucketBy(buckets, "run_id").sortBy("run_id")
     .option("path", path).mode("append").saveAsTable(table))
    return table


def series_and_params(metrics: DataFrame, params: DataFrame, key: str, param_keys: Sequence[str]) -> DataFrame:
    """One row per run: first, last and best value of a metric beside its parameters, one column for each.

    For two tables of :func:`save_by_run` with one number of buckets the plan has no exchange above the scans: both
    are grouped and joined in the buckets they lie in. Runs without the metric, or without parameters, keep nulls.
    """
    wide = params_side_by_side(params, param_keys)
    return wide.join(run_summary(metrics, key), "run_id", "full")
