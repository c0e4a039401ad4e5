"""Fitting, scoring, and functions per rank."""

import re

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from fitledger.catalog import models, tables, text
from fitledger.models import (
    batch_score, foreign_scores, linear_text_model, load_model, loader, run_per_rank, save_model, score_prompts, supervised_fit,
)
from fitledger.models.linear import murmur3
from conftest import MEDIUM, SMALL


@pytest.fixture(scope="module")
def labelled(spark):
    return tables.table(spark, MEDIUM, "documents").select("doc_id", "text").join(
        tables.table(spark, MEDIUM, "labels"), "doc_id")


@pytest.fixture(scope="module")
def model(labelled):
    return supervised_fit(labelled, "quality")


def test_fit_beats_the_majority_class_on_its_training_rows(labelled, model):
    scored = batch_score(labelled, model, "doc_id").join(labelled, "doc_id")
    right, total, ones = scored.agg(
        F.count_if(F.col("prediction") == F.col("quality")), F.count("*"), F.sum("quality")).first()
    assert right > max(ones, total - ones)


def test_held_out_rows(labelled):
    """Held-out rows: more right than the majority class, good text ranked above bad text."""
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(5))
    fitted = supervised_fit(labelled.filter(fold > 0), "quality")
    scored = batch_score(labelled.filter(fold == 0), fitted, "doc_id", keep=["quality"])
    right, total, ones = scored.agg(
        F.count_if(F.col("prediction") == F.col("quality")), F.count("*"), F.sum("quality")).first()
    assert right > max(ones, total - ones)
    area = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label").evaluate(
        scored.withColumn("label", F.col("quality").cast("double")))
    assert area > 0.75


def test_saved_model_scores_alike(labelled, model, tmp_path):
    save_model(model, str(tmp_path / "m"))
    again = load_model(str(tmp_path / "m"))
    assert batch_score(labelled, again, "doc_id").exceptAll(batch_score(labelled, model, "doc_id")).isEmpty()


def test_a_model_goes_to_tasks_after_rows_were_observed(spark, labelled, tmp_path):
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).write.parquet(str(tmp_path / "x"))
    assert seen.get == {"n": 3}
    fitted = supervised_fit(labelled, "quality")
    batch_score(labelled, fitted, "doc_id").write.parquet(str(tmp_path / "y"))
    assert not fitted.stages[-1].hasSummary


def test_prompts_reach_the_model_in_batches(spark):
    def make_model():
        return lambda texts, limit: [t.upper()[:limit] for t in texts]

    df = spark.range(10).select("id", F.concat(F.lit("q"), "id").alias("prompt"))
    got = score_prompts(df, make_model, "id", max_new_tokens=1)
    assert got.count() == 10 and {r["answer"] for r in got.collect()} == {"Q"}


def test_prompts_query_answers_every_prompt(spark, tmp_path):
    turns = [(1, t, role, text) for t, (role, text) in enumerate(
        [("user", "one\u00a0two  three"), ("assistant", "yes"), ("user", "word " * 300), ("assistant", "no")])]
    turns = spark.createDataFrame(turns + turns, tables.SCHEMAS["conversations"])
    turns.write.parquet(f"{tmp_path}/conversations.parquet")
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    asked = text.prompts(spark, str(tmp_path)).collect()
    rows = models.QUERIES["score_prompts"](spark, str(tmp_path)).collect()
    assert sorted((r.example_id, r.answer) for r in rows) == sorted(
        (a.example_id, " ".join(re.findall("[^\t\n\f\r ]+", a.prompt)[:100])) for a in asked)
    assert all(r.same and r.prediction_follows for r in rows) and max(len(r.answer.split(" ")) for r in rows) == 100


def test_weights_score_alike_outside_mllib(spark, labelled, model):
    odd = spark.createDataFrame([(-1, ""), (-2, " \u3000\t"), (-3, "Ünï cödé 😀 word word"), (-4, "x" * 100_000), (-4, "same id")],
                                "doc_id bigint, text string")
    docs = labelled.select("doc_id", "text").unionByName(odd)
    inside = sorted((r.doc_id, round(r.score, 9)) for r in batch_score(docs, model, "doc_id").collect())
    outside = foreign_scores(docs, loader(spark, linear_text_model(model)), "doc_id", "text")
    assert sorted((r.doc_id, round(r.score, 9)) for r in outside.collect()) == inside
    assert foreign_scores(docs.limit(0), loader(spark, linear_text_model(model)), "doc_id", "text").count() == 0
    null = spark.createDataFrame([(1, None)], "doc_id bigint, text string")
    assert foreign_scores(null, loader(spark, linear_text_model(model)), "doc_id", "text").first().score == pytest.approx(
        [r.score for r in batch_score(odd, model, "doc_id").collect() if r.doc_id == -1][0])


def test_hash_of_terms(spark):
    from pyspark.ml.feature import HashingTF

    terms = ["", "a", "ab", "abc", "abcd", "abcde", "ü€😀", "word" * 100]
    size = 1 << 16
    rows = spark.createDataFrame([(t, [t]) for t in terms], "t string, words array<string>")
    for r in HashingTF(inputCol="words", outputCol="f", numFeatures=size).transform(rows).collect():
        h = murmur3(r.t.encode())
        assert list(r.f.indices) == [(h - (1 << 32) if h >> 31 else h) % size]


def test_a_model_is_loaded_once_in_each_process(spark, tmp_path):
    folder = str(tmp_path)

    def make_predict():
        import os
        import uuid

        import numpy as np

        open(f"{folder}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return lambda x: np.array([float(os.getpid())] * len(x))

    df = spark.range(4000).repartition(40).select("id", F.col("id").cast("string").alias("prompt"))
    processes = {r.score for r in foreign_scores(df, make_predict, "id", "prompt", batch_rows=16).collect()}
    loads = list(tmp_path.iterdir())
    assert len(loads) == len({p.name.split("-")[0] for p in loads}) <= 16
    assert processes <= {float(p.name.split("-")[0]) for p in loads}


def test_ranks_share_the_rows_and_one_result_returns(spark):
    def share(context, batches, factor):
        import pandas as pd

        mine = sum(len(b) for b in batches)
        counts = [int(c) for c in context.allGather(str(mine))]
        return pd.DataFrame({"rank": [context.partitionId()], "ranks": [len(counts)], "rows": [factor * sum(counts)]})

    got = run_per_rank(tables.table(spark, SMALL, "events"), share, 4, "rank int, ranks int, rows bigint", factor=2)
    assert [tuple(r) for r in got.collect()] == [(0, 4, 2000)]


def test_nothing_returned_is_an_empty_table(spark):
    def quiet(context, batches):
        for _ in batches:
            pass

    assert run_per_rank(spark.range(8), quiet, 2, "x int").isEmpty()
