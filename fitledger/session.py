"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# A side of a join is broadcast only when it has at most this many rows.
# The callers' rows are narrow (keys and a few counters), below 64 bytes each.
MAX_BROADCAST_ROWS = 1_000_000
# The same for rows that hold text, whose length is counted too.
MAX_BROADCAST_BYTES = 256 << 20
PARTITION_BYTES = 256 << 20


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on.

    Shuffle partition counts are left to the cluster's own configuration; AQE
    coalesces small ones and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_settings(shuffled_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a job that shuffles about ``shuffled_bytes``, to pass to :func:`build_session`.

    Partitions of some 256 MB fit an executor's memory without spilling, and three
    per core even out stragglers. AQE merges what turns out to be small but cannot
    raise the number, so it has to start high enough.
    """
    partitions = max(-(-shuffled_bytes // PARTITION_BYTES), 3 * cores)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
    }


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a machine-local folder would be lost with its machine, so a missing
    setting is an error there.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if named is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="fitledger-"))
    return (named or context.getCheckpointDir()).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so never overwritten."""
    return f"{_scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _scratch_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/fitledger/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has written to the shared folder by :func:`scratch_path`.

    To be called when nothing that was read from there is needed any more: DataFrames are lazy, and only the
    caller knows. Other applications' folders stay.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(_scratch_folder(spark))
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.delete(folder, True)


def saved(df: DataFrame) -> DataFrame:
    """Materialise a small intermediate on reliable storage and cut its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def saved_table(df: DataFrame, label: str) -> DataFrame:
    """Write a large intermediate once as Parquet in the shared folder and read it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` after counting it; beyond ``max_rows`` Spark picks a shuffle join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def text_fits(df: DataFrame, column: str, max_rows: int = MAX_BROADCAST_ROWS,
              max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a table with a text column is small enough to go to every executor."""
    rows, size = df.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes
