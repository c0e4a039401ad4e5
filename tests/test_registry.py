"""Checkpoints, experiments and artifacts."""

import datetime as dt

from pyspark.sql import functions as F

from fitledger.catalog import tables
from fitledger.operators import checkpoints as ck
from fitledger.operators import registry as reg
from fitledger.sources.artifacts import artifact_manifest, file_listing
from conftest import MEDIUM


def test_checkpoints_are_due_every_200_steps(spark):
    df = spark.range(1, 91).select(F.lit("r").alias("run_id"), (F.col("id") * 10).alias("step"))
    plan = ck.checkpoint_plan(df.unionAll(df))
    assert [tuple(r) for r in plan.orderBy("step").collect()] == [
        ("r", s, f"checkpoint-{s}") for s in (200, 400, 600, 800)]


def test_newest_are_kept(spark):
    plan = ck.checkpoint_plan(tables.logs(spark, MEDIUM))
    for n in (1, 2, 3):
        kept = ck.retain_latest(plan, n)
        assert kept.groupBy("run_id").count().agg(F.max("count")).first()[0] <= n
        dropped = plan.join(kept, ["run_id", "step"], "left_anti")
        oldest_kept = kept.groupBy("run_id").agg(F.min("step").alias("oldest"))
        assert dropped.join(oldest_kept, "run_id").filter("step >= oldest").isEmpty()
        assert dropped.join(oldest_kept, "run_id", "left_anti").isEmpty()


def test_rank_limit_is_applied_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("run_id"), F.col("id").alias("step"))
    assert "WindowGroupLimit" in ck.retain_latest(df)._jdf.queryExecution().toString()


def test_missing_and_pending(spark):
    plan = spark.createDataFrame([(1, 200, "checkpoint-200"), (1, 400, "checkpoint-400")], "run_id int, step int, path string")
    there = spark.createDataFrame([(1, "checkpoint-400"), (2, "checkpoint-200")], "run_id int, path string")
    assert [r["step"] for r in ck.existing_only(plan, there).collect()] == [400]
    assert [r["step"] for r in ck.pending_uploads(plan, there).collect()] == [200]


def test_folders_of_a_manifest(spark, tmp_path):
    for name in ("checkpoint-200", "checkpoint-400", "other"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "weights.bin").write_bytes(b"1")
    (tmp_path / "checkpoint-200" / "state.bin").write_bytes(b"1")
    manifest = artifact_manifest(spark, str(tmp_path), "r1", "checkpoints")
    plan = spark.createDataFrame(
        [("r1", s, f"checkpoint-{s}") for s in (200, 400, 600)], "run_id string, step bigint, path string")
    there = ck.existing_only(plan, ck.checkpoint_folders(manifest))
    assert sorted(r["step"] for r in there.collect()) == [200, 400]


def test_folders_as_they_lie(spark, tmp_path):
    """Checkpoint folders that a job has written, some missing: what is there, what is pending, what retention removes."""
    directory = str(tmp_path / "runs")
    rows = [(r, s, f"checkpoint-{s}") for r in (1, 2, 3) for s in (200, 400, 600, 800)] + [(None, 200, "checkpoint-200")]
    plan = spark.createDataFrame(rows, "run_id bigint, step bigint, path string")
    written = plan.filter("not (run_id = 2 and step in (400, 800)) and not (run_id = 3 and step > 200)")
    states = written.select("run_id", "path", F.explode(F.sequence(F.lit(1), F.lit(50))).alias("weight"))
    ck.write_checkpoints(states.filter("run_id is not null"), directory)
    folders = ck.checkpoint_folders(file_listing(spark, directory))
    there = [(1, 200), (1, 400), (1, 600), (1, 800), (2, 200), (2, 600), (3, 200)]
    assert sorted((r.run_id, r.step) for r in ck.existing_only(plan, folders).collect()) == there
    assert sorted((r.run_id, r.step) for r in ck.pending_uploads(plan.filter("run_id > 0"), folders).collect()) == [
        (2, 400), (2, 800), (3, 400), (3, 600), (3, 800)]
    assert sorted((r.run_id, r.step) for r in ck.expired(ck.steps_of(folders)).collect()) == [(1, 200), (1, 400)]
    assert ck.expired(ck.steps_of(folders), 1).count() == 4 and ck.expired(ck.steps_of(folders), 9).isEmpty()
    assert spark.read.parquet(directory).count() == 50 * len(there)


def test_folders_are_those_of_sparks_writer_without_its_processes(spark, tmp_path):
    runs = ["a", "", None, "x y", "ü/é:=%", "q?*[{^"]
    rows = [(r, p, i, dt.datetime(2024, 1, 1, i % 24)) for i, (r, p) in enumerate(
        (r, p) for r in runs for p in ["checkpoint-200", "checkpoint-400", None] for _ in range(3))]
    states = spark.createDataFrame(rows, "run_id string, path string, weight int, at timestamp")
    ours, theirs = str(tmp_path / "ours"), str(tmp_path / "theirs")
    for _ in range(2):
        ck.write_checkpoints(states, ours)
    states.unionByName(states).write.partitionBy("run_id", "path").parquet(theirs)
    folders = [sorted(str(p.relative_to(d)) for p in (tmp_path / d).rglob("*") if p.is_dir()) for d in (ours, theirs)]
    assert folders[0] == folders[1] and len(folders[0]) == 5 + 5 * 3
    assert spark.read.parquet(ours).exceptAll(spark.read.parquet(theirs)).isEmpty()
    assert spark.read.parquet(ours).count() == 2 * len(rows)
    # Hadoop's local file system makes a .crc of each file, and starts processes for both.
    assert not list((tmp_path / "ours").rglob("*.crc")) and list((tmp_path / "theirs").rglob("*.crc"))
    empty = str(tmp_path / "empty")
    ck.write_checkpoints(states.limit(0), empty)
    assert file_listing(spark, empty).isEmpty()


def test_listing_reads_no_file(spark, tmp_path):
    for i in range(40):
        folder = tmp_path / f"d{i}"
        folder.mkdir()
        (folder / "ü é.bin").write_bytes(b"x" * i)
    files = file_listing(spark, str(tmp_path))
    assert sorted(r.length for r in files.collect()) == list(range(1, 40))      # the empty file is not listed
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()


def test_experiments_are_created_once(spark):
    existing = spark.createDataFrame([("a",), ("b",)], "experiment string")
    incoming = spark.createDataFrame([("b",), ("c",), ("c",), ("d",)], "experiment string")
    assert sorted(r[0] for r in reg.new_experiments(existing, incoming).collect()) == ["c", "d"]
    after = reg.register_experiments(existing, incoming)
    assert sorted(r[0] for r in after.collect()) == ["a", "b", "c", "d"]
    assert reg.new_experiments(after, incoming).isEmpty()


def test_experiment_name(spark):
    name, user = spark.range(1).select(reg.experiment_name(F.lit("tuning")), F.current_user()).first()
    assert name == f"/Workspace/Users/{user}/tuning"


def test_manifest_walks_the_tree(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "x.bin").write_bytes(b"12345")
    (tmp_path / "a" / "b" / "y.txt").write_text("hi")
    found = artifact_manifest(spark, str(tmp_path), "r1", "checkpoints/checkpoint-200")
    got = sorted((r["path"].rsplit("/", 1)[1], r["length"]) for r in found.collect())
    assert got == [("x.bin", 5), ("y.txt", 2)]
    first = found.first()
    assert (first["run_id"], first["artifact_path"]) == ("r1", "checkpoints/checkpoint-200")
    assert isinstance(first["modificationTime"], dt.datetime)


def test_a_second_call_creates_nothing(spark, tmp_path):
    path = str(tmp_path / "experiments")
    reg.create_registry(spark, path)
    names = spark.createDataFrame([("a",), ("b",), ("b",)], "experiment string")
    for _ in range(2):
        assert sorted(r[0] for r in reg.get_or_create(spark, path, names).collect()) == ["a", "b"]
        assert spark.read.parquet(path).count() == 2
    more = spark.createDataFrame([("b",), ("c",)], "experiment string")
    assert sorted(r[0] for r in reg.get_or_create(spark, path, more).collect()) == ["a", "b", "c"]


def test_nothing_is_saved_at_step_zero(spark):
    df = spark.createDataFrame([("r", 0), ("r", 200)], "run_id string, step bigint")
    assert [r["step"] for r in ck.checkpoint_plan(df).collect()] == [200]
