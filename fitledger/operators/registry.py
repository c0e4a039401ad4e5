"""Experiments, run parameters and tags as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fitledger.session import saved

# Fixed value: where a user's experiments live.
EXPERIMENT_FORMAT = "/Workspace/Users/%s/%s"

# The names of a parameter's type.
TYPE_NAMES = {
    "string": "str", "boolean": "bool",
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int",
    "float": "float", "double": "float",
}


def experiment_name(suffix: Column) -> Column:
    """The experiment's path below the current user's folder."""
    return F.format_string(EXPERIMENT_FORMAT, F.current_user(), suffix)


def new_experiments(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Names to create: asked for, not there yet, each once."""
    names = incoming.select("experiment").distinct()
    return names.join(existing.select("experiment"), "experiment", "left_anti")


def register_experiments(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """The registry after get-or-create, each name once."""
    return existing.select("experiment").distinct().unionByName(new_experiments(existing, incoming))


def get_or_create(spark: SparkSession, path: str, incoming: DataFrame) -> DataFrame:
    """Append the names that the registry at ``path`` lacks, and return the registry.

    The folder must exist: :func:`create_registry` makes an empty one. A second call with the same names
    appends nothing, and two jobs that create one name at a time are read as one.
    """
    known = spark.read.schema("experiment string").parquet(path)
    missing = saved(new_experiments(known, incoming))
    if not missing.isEmpty():
        missing.write.mode("append").parquet(path)
    return spark.read.schema("experiment string").parquet(path).distinct()


def create_registry(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], "experiment string").write.parquet(path)


def register_runs(runs: DataFrame, suffix: Column, run_name: Column) -> DataFrame:
    """``run_id, experiment, run_name, username``: one row per run, in the current user's name."""
    return runs.select("run_id").distinct().select(
        "run_id",
        experiment_name(suffix).alias("experiment"),
        run_name.alias("run_name"),
        F.current_user().alias("username"),
    )


def melt_params(df: DataFrame, id_column: str, columns: Sequence[str]) -> DataFrame:
    """``run_id, key, value, value_type``: one row per parameter that is set."""
    types = dict(df.dtypes)
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("key"),
            _as_text(F.col(name), types[name]).alias("value"),
            F.lit(TYPE_NAMES.get(types[name], types[name])).alias("value_type"),
        )
        for name in columns
    ])
    return (
        df.select(F.col(id_column).cast("string").alias("run_id"), F.inline(rows))
        .filter(F.col("value").isNotNull())
    )


def _as_text(col: Column, dtype: str) -> Column:
    text = col.cast("string")
    return F.initcap(text) if dtype == "boolean" else text
