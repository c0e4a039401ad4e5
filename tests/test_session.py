"""Where intermediates go, and how sizes are chosen."""

import pytest

from fitledger import session as s


def test_shared_dir_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is not None:
        assert s.shared_dir(spark) == configured.rstrip("/")
    assert s.shared_dir(spark) == s.shared_dir(spark)
    assert s.scratch_path(spark, "x") != s.scratch_path(spark, "x")
    assert s.scratch_path(spark, "x").startswith(s.shared_dir(spark))


class _Cluster:
    """A session on a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError):
        s.shared_dir(_Cluster)


def test_saved_forms_keep_the_rows(spark):
    df = spark.range(100).selectExpr("id", "cast(id as string) as name")
    assert s.saved(df).exceptAll(df).isEmpty()
    table = s.saved_table(df, "numbers")
    assert table.dtypes == df.dtypes and table.exceptAll(df).isEmpty()


def test_broadcast_depends_on_the_size(spark):
    plan = lambda df: df._jdf.queryExecution().toString()
    assert "broadcast" in plan(s.broadcast_if_small(spark.range(10), 10)).lower()
    assert "broadcast" not in plan(s.broadcast_if_small(spark.range(11), 10)).lower()
    words = spark.createDataFrame([("abc",), ("日本",)], "word string")
    assert s.text_fits(words, "word", 2, 9)
    assert not s.text_fits(words, "word", 2, 8)
    assert not s.text_fits(words, "word", 1, 9)


def test_shuffle_settings():
    small, large = s.shuffle_settings(1, 8), s.shuffle_settings(10 << 40, 4000)
    assert small["spark.sql.shuffle.partitions"] == "24"
    assert large["spark.sql.shuffle.partitions"] == str((10 << 40) // (256 << 20))


def test_scratch_is_cleared_for_this_application_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(s, "shared_dir", lambda _: str(tmp_path))
    other = tmp_path / "fitledger" / "another-application"
    other.mkdir(parents=True)
    table = s.saved_table(spark.range(3), "x")
    assert table.count() == 3 and len(list((tmp_path / "fitledger").iterdir())) == 2
    s.clear_scratch(spark)
    assert [p.name for p in (tmp_path / "fitledger").iterdir()] == ["another-application"]
    s.clear_scratch(spark)
    assert s.saved_table(spark.range(2), "x").count() == 2
