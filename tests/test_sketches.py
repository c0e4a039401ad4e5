"""Stored length sketches, frequent words by summaries, and tables bucketed by run."""

import random

import pytest
from pyspark.sql import functions as F

from fitledger import schemas
from fitledger.operators import vocabulary
from fitledger.operators.length_sketches import RANK_ERROR, append_lengths, merged_profile, read_lengths
from fitledger.operators.vocabulary import build_vocabulary, frequent_words
from fitledger.sources.run_tables import save_by_run, series_and_params


def test_merged_sketches_are_near_the_exact_profile(spark, tmp_path):
    path = str(tmp_path / "lengths")
    lengths = spark.range(60_000).select(F.floor(F.pow(F.rand(7), 3) * 5000).cast("int").alias("n_tokens")).cache()
    for i, part in enumerate(lengths.randomSplit([0.5, 0.3, 0.2], seed=1)):
        append_lengths(part, path, f"append-{i}", groups=8)
    append_lengths(lengths.limit(0), path, "empty")
    sketches = read_lengths(spark, path)
    assert 3 <= sketches.count() <= 24 and sketches.filter("part = 'empty'").isEmpty()
    got = merged_profile(sketches, [100, 1024, 2048, 4999, 10**6]).first()
    exact = lengths.agg(F.count("*"), F.sum("n_tokens"), F.max("n_tokens")).first()
    assert (got.examples, got.tokens, got.longest) == tuple(exact)
    for cap in (100, 1024, 2048, 4999, 10**6):
        assert abs(got[f"over_{cap}"] - lengths.filter(F.col("n_tokens") > cap).count()) <= RANK_ERROR * 60_000
    for p, q in ((50, 0.5), (90, 0.9), (99, 0.99)):
        below = lengths.filter(F.col("n_tokens") <= got[f"p{p}"]).count() / 60_000
        atleast = lengths.filter(F.col("n_tokens") < got[f"p{p}"]).count() / 60_000
        assert atleast - RANK_ERROR <= q <= below + RANK_ERROR


def test_an_append_reads_its_own_rows_only(spark, tmp_path):
    path = str(tmp_path / "lengths")
    append_lengths(spark.range(10).select(F.col("id").alias("n_tokens")), path, "first")
    before = {r.part: bytes(r.lengths) for r in read_lengths(spark, path).collect()}
    append_lengths(spark.createDataFrame([(5,), (None,)], "n_tokens int"), path, "second")
    after = {r.part: (r.examples, bytes(r.lengths)) for r in read_lengths(spark, path).collect()}
    assert after["first"][1] == before["first"] and after["second"][0] == 1
    assert merged_profile(read_lengths(spark, path), [4]).first().over_4 == 6
    nothing = merged_profile(read_lengths(spark, path).limit(0), [4]).first()
    assert (nothing.examples, nothing.p50, nothing.over_4) == (None, None, None)


def documents(spark, rng, n):
    """Words of a long tail, one word that is a third of all, and nulls."""
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(n)] + ["the"] * (n // 2) + ["a b"[:1]] * 5
    rng.shuffle(words)
    rows = [(i, words[i * 20:(i + 1) * 20]) for i in range(len(words) // 20)] + [(-1, None), (-2, []), (-3, [None, "the"])]
    return spark.createDataFrame(rows, "id int, tokens array<string>").repartition(6)


@pytest.mark.parametrize("counters", [None, 400, 60])
@pytest.mark.parametrize("size", [1, 30, 100])
def test_frequent_words_are_the_exact_ones(spark, counters, size):
    df = documents(spark, random.Random(size), 30_000).cache()
    expected = build_vocabulary(df, size)
    assert sorted(map(tuple, frequent_words(df, size, counters=counters).collect())) == sorted(map(tuple, expected.collect()))


def test_summaries_bound_the_shuffle(spark, tmp_path, monkeypatch):
    """Where the summaries can tell, the types that are no candidates are counted nowhere; where they can't, all are."""
    df = documents(spark, random.Random(3), 30_000).cache()
    called = []
    monkeypatch.setattr(vocabulary, "build_vocabulary", lambda *a: called.append(a) or build_vocabulary(*a))
    frequent_words(df, 5, counters=200).collect()
    assert not called
    alike = spark.createDataFrame([(i, [f"t{j}" for j in range(i, i + 50)]) for i in range(0, 4000, 50)], "id int, tokens array<string>")
    got = frequent_words(alike.repartition(2), 10, counters=20)
    assert called and sorted(r.token for r in got.collect()) == sorted(f"t{j}" for j in range(4000))[:10]
    assert frequent_words(df.limit(0), 5).count() == 0
    assert frequent_words(spark.createDataFrame([(1, ["x", "y", "x"])], "id int, tokens array<string>"), 10).count() == 2


def test_summaries_are_given_some_lists_at_a_time(spark, monkeypatch):
    summary = vocabulary._summary

    def watched(kept):
        def summarise(batches):
            def small():
                for batch in batches:
                    assert batch.num_rows <= 1_000
                    yield batch

            return summary(kept)(small())

        return summarise

    monkeypatch.setattr(vocabulary, "_summary", watched)
    before = spark.conf.get(vocabulary.BATCH_ROWS)
    df = spark.range(0, 5_000, 1, 1).select(F.array(F.lit("a"), F.col("id").cast("string")).alias("tokens"))
    assert frequent_words(df, 1).first()["n"] == 5_000 and spark.conf.get(vocabulary.BATCH_ROWS) == before


def test_tables_by_run_meet_without_an_exchange(spark, tmp_path):
    points = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("run_id"), F.col("id").alias("event_id"),
        F.lit("loss").alias("key"), (F.col("id") % 11).cast("double").alias("value"), F.col("id").alias("step"),
        F.lit(None).cast("timestamp").alias("log_time"))
    params = spark.createDataFrame([(str(r), k, f"{k}{r}", "str") for r in range(10, 60) for k in ("lr", "epochs")], schemas.PARAMS)
    tables = [spark.table(save_by_run(df, str(tmp_path / name), buckets=8)) for name, df in (("points", points), ("params", params))]
    found = series_and_params(*tables, "loss", ["lr", "epochs"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    got = {r.run_id: r for r in found.collect()}
    assert set(got) == set(range(60))
    assert got[7].points == points.filter("run_id = 7").count() and got[7].lr is None
    assert (got[55].lr, got[55].epochs, got[55].points) == ("lr55", "epochs55", None)
    last = points.filter("run_id = 20").orderBy(F.desc("step")).first()
    assert (got[20].last_value, got[20].last_step, got[20].lr) == (last.value, last.step, "lr20")
    more = spark.table(save_by_run(points.limit(0), str(tmp_path / "none"), buckets=8))
    assert series_and_params(more, tables[1], "loss", ["lr"]).count() == 50
