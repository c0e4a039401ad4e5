"""Checkpoints: when they are due, which are kept, which still need an upload."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from fitledger.operators.metrics import every_n_steps

# Fixed values of the training recipe.
SAVE_STEPS = 200
SAVE_LIMIT = 2
FOLDER_FORMAT = "checkpoint-%d"
# Characters that Spark writes as %XX in the names of folders.
_ESCAPED = re.compile(r"""[\x01-\x1F"#%'*/:=?\\\x7F{\[\]^]""")


def checkpoint_plan(df: DataFrame, every: int = SAVE_STEPS) -> DataFrame:
    """``run_id, step, path`` of the checkpoints due among the given run steps."""
    # Saves follow updates: nothing is due at step 0.
    due = every_n_steps(df.select("run_id", "step").filter(F.col("step") > 0), every).distinct()
    return due.withColumn("path", F.format_string(FOLDER_FORMAT, "step"))


def retain_latest(checkpoints: DataFrame, n: int = SAVE_LIMIT) -> DataFrame:
    """The newest ``n`` checkpoints of each run.

    The rank filter is applied per task before the shuffle too, so a run with
    very many checkpoints sends only ``n`` rows per task.
    """
    newest_first = Window.partitionBy("run_id").orderBy(F.desc("step"))
    return (
        checkpoints.withColumn("age", F.row_number().over(newest_first))
        .filter(F.col("age") <= n).drop("age")
    )


def expired(checkpoints: DataFrame, n: int = SAVE_LIMIT) -> DataFrame:
    """The checkpoints that retention removes: all but the newest ``n`` of each run."""
    oldest = retain_latest(checkpoints, n).groupBy("run_id").agg(F.min("step").alias("oldest_kept"))
    return checkpoints.join(oldest, "run_id").filter(F.col("step") < F.col("oldest_kept")).drop("oldest_kept")


def existing_only(plan: DataFrame, manifest: DataFrame) -> DataFrame:
    """Checkpoints whose folder is really there."""
    return plan.join(manifest, ["run_id", "path"], "left_semi")


def write_checkpoints(states: DataFrame, directory: str, files: int = 1) -> None:
    """Write the state of each checkpoint (run_id, path, ..) into a folder of its own, below its run's.

    Tasks get whole checkpoints, so a folder has one file, or up to ``files`` of them where states are large. There are
    as many tasks as shuffle partitions, whatever the bytes: what takes time is making the folders.
    On a mounted file system tasks write the files through Arrow: Hadoop's local file system starts two processes
    for each. A file gets its name when it is whole, the same name when its task runs again.
    """
    spark = states.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64(*states.columns), F.lit(files))
    dealt = states.repartition(tasks, "run_id", "path", part) if files > 1 else states.repartition(tasks, "run_id", "path")
    place = spark._jvm.org.apache.hadoop.fs.Path(directory)
    mounted = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme() == "file"
    # Types that Arrow does not carry as they are go through Spark's writer, too.
    if not mounted or re.search("variant|interval|void|char", states.schema.simpleString()):
        dealt.write.mode("append").partitionBy("run_id", "path").parquet(directory)
        return
    local = place.toUri().getPath()
    os.makedirs(local, exist_ok=True)
    names = [F.col(c).cast("string").alias(f"_{c}") for c in ("run_id", "path")]
    rows = dealt.sortWithinPartitions("run_id", "path").select(
        *names, *[c for c in states.columns if c not in ("run_id", "path")])
    rows.mapInArrow(_folder_writer(local, uuid.uuid4().hex), "files bigint").agg(F.sum("files")).collect()


def _folder_writer(directory: str, label: str):
    """Write sorted rows, of which the first two columns name the folder, into a file for each folder."""
    def folder(run: str | None, path: str | None) -> str:
        named = (_ESCAPED.sub(lambda c: f"%{ord(c.group()):02X}", v) if v else "__HIVE_DEFAULT_PARTITION__" for v in (run, path))
        return "{}/run_id={}/path={}".format(directory, *named)

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq

        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{label}.snappy.parquet"
        draft, at, writer, written = f".{name}-{task.taskAttemptId()}", None, None, 0

        def finish() -> None:
            writer.close()
            os.replace(f"{at}/{draft}", f"{at}/{name}")

        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            rows = pa.RecordBatch.from_arrays(batch.columns[2:], schema=pa.schema(list(batch.schema)[2:]))
            starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
            for start, end in zip(starts, [*starts[1:], len(keys)]):
                place = folder(*keys[start])
                if place != at:
                    if writer:
                        finish()
                    os.makedirs(place, exist_ok=True)
                    at, writer = place, pq.ParquetWriter(f"{place}/{draft}", rows.schema)
                    written += 1
                writer.write_batch(rows.slice(start, end - start))
        if writer:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([written], pa.int64())], ["files"])

    return write


def checkpoint_folders(files: DataFrame) -> DataFrame:
    """``run_id, path`` of the checkpoint folders that hold at least one listed file.

    The run is a column of the listing (an artifact manifest), or else the ``run_id=`` folder above the checkpoint's.
    """
    folder = F.regexp_extract("path", "/(?:path=)?(checkpoint-[0-9]+)/", 1).alias("path")
    run = F.col("run_id") if "run_id" in files.columns else F.regexp_extract(
        "path", "/run_id=([^/]+)/", 1).try_cast("bigint").alias("run_id")
    return files.select(run, folder).filter(F.col("path") != "").distinct()


def steps_of(folders: DataFrame) -> DataFrame:
    """``run_id, step, path``: the steps that the folders' names tell."""
    step = F.regexp_extract("path", "^checkpoint-([0-9]+)$", 1).try_cast("bigint")
    return folders.select("run_id", step.alias("step"), "path").filter(F.col("step").isNotNull())


def pending_uploads(started: DataFrame, finished: DataFrame) -> DataFrame:
    """Uploads that were started and are not finished."""
    return started.join(finished, ["run_id", "path"], "left_anti")
