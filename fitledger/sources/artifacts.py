"""File trees registered under a run as artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def file_listing(spark: SparkSession, directory: str) -> DataFrame:
    """``path, length, modificationTime`` of all files below ``directory``, from the file-metadata column.

    The rows are made by tasks, and no file is read. Trees of many folders are listed by tasks, too. Files without
    a byte are not listed: Spark reads none.
    """
    # Spark would start a task for each folder below the first, up to 10,000, which takes longer than to list it.
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, 8 * spark.sparkContext.defaultParallelism)
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory)
    finally:
        spark.conf.set(LISTING_TASKS, before)
    return files.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modificationTime"))


def artifact_manifest(spark: SparkSession, directory: str, run_id: str, artifact_path: str) -> DataFrame:
    """One row per file below ``directory``; file contents are never read."""
    return file_listing(spark, directory).select(
        F.lit(run_id).alias("run_id"), F.lit(artifact_path).alias("artifact_path"), "path", "length", "modificationTime")
