"""Queries that fit, save, score, and run a function per rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fitledger.catalog.tables import table
from fitledger.catalog.text import SQL as TEXT_SQL, prompts
from fitledger.models import (
    batch_score, foreign_scores, linear_text_model, load_model, loader, run_per_rank, save_model, score_prompts,
    supervised_fit,
)
from fitledger.session import broadcast_if_small, saved_table, scratch_path

# Partial sums for each rank.
SHARES = 16
FOLDS = 5


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents; the labels go to every executor if they are few, so that no text is shuffled."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return table(spark, sf_dir, "documents").select("doc_id", "text").join(broadcast_if_small(labels), "doc_id")


def _fold(column: str) -> Column:
    digits = F.substring(F.md5(F.col(column).cast("string")), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") % FOLDS


def fit(spark, sf_dir):
    """Fitted on four folds of five and judged on the fifth: is it right at least as often as the
    commoner class would be, with scores that are probabilities?"""
    labelled = _labelled(spark, sf_dir).withColumn("fold", _fold("doc_id"))
    model = supervised_fit(labelled.filter(F.col("fold") > 0), "quality")
    scored = batch_score(labelled.filter(F.col("fold") == 0), model, "doc_id", keep=["quality"])
    return scored.agg(
        F.count(F.lit(1)).alias("documents"),
        (F.count_if(F.col("prediction") == F.col("quality"))
         >= F.greatest(F.count_if(F.col("quality") == 1), F.count_if(F.col("quality") == 0))).alias("no_worse_than_majority"),
        F.bool_and(F.col("score").between(0, 1)).alias("in_range"),
    )


def saved_model(spark, sf_dir):
    path = scratch_path(spark, "model")
    labelled = _labelled(spark, sf_dir)
    model = supervised_fit(labelled, "quality")
    save_model(model, path)
    before = batch_score(labelled, model, "doc_id")
    after = batch_score(labelled, load_model(path), "doc_id")
    same = before.join(after.withColumnsRenamed({"prediction": "p2", "score": "s2"}), "doc_id")
    return same.select("doc_id", ((F.col("prediction") == F.col("p2")) & (F.col("score") == F.col("s2"))).alias("same"))


def scores(spark, sf_dir):
    """Every document has a score between 0 and 1, and the prediction follows it."""
    model = supervised_fit(_labelled(spark, sf_dir), "quality")
    scored = batch_score(table(spark, sf_dir, "documents"), model, "doc_id")
    return scored.select(
        "doc_id", F.col("score").between(0, 1).alias("in_range"),
        ((F.col("score") > 0.5) == (F.col("prediction") == 1)).alias("prediction_follows"))


def foreign_answers(spark, sf_dir):
    """Prompts answered, up to the limit of tokens, by a model that repeats them, and scored by the fitted weights outside
    MLlib and by MLlib: the same for every prompt. Rows are never joined, so prompts that share an id stay apart."""
    def make_model():
        import re

        # The white space of SQL's regular expressions.
        return lambda texts, limit: [" ".join([w for w in re.split("[\t\n\f\r ]+", t) if w][:limit]) for t in texts]

    model = supervised_fit(_labelled(spark, sf_dir), "quality")
    asked = saved_table(prompts(spark, sf_dir), "prompts")
    answered = score_prompts(asked, make_model, "example_id", keep=["prompt"])
    load = loader(spark, linear_text_model(model))
    outside = saved_table(
        foreign_scores(answered, load, "example_id", "prompt", "outside", keep=["prompt", "answer"]), "outside")
    both = batch_score(outside.withColumnRenamed("prompt", "text"), model, "example_id", keep=["answer", "outside"])
    return both.select(
        "example_id", "answer", (F.abs(F.col("outside") - F.col("score")) < 1e-9).alias("same"),
        ((F.col("outside") > 0.5) == (F.col("prediction") == 1)).alias("prediction_follows"))


def foreign_document_scores(spark, sf_dir):
    """Every document scored outside MLlib, against ``batch_score``."""
    model = supervised_fit(_labelled(spark, sf_dir), "quality")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    outside = foreign_scores(documents, loader(spark, linear_text_model(model)), "doc_id", "text", "outside")
    both = outside.join(saved_table(batch_score(documents, model, "doc_id"), "inside"), "doc_id")
    return both.select("doc_id", (F.abs(F.col("outside") - F.col("score")) < 1e-9).alias("same"))


def rank_sums(spark, sf_dir):
    def add_up(context, batches):
        import json

        import pandas as pd

        rows = characters = 0
        for batch in batches:
            rows += int(batch["documents"].sum())
            characters += int(batch["characters"].sum())
        shares = [json.loads(s) for s in context.allGather(json.dumps([rows, characters]))]
        return pd.DataFrame({
            "documents": [sum(s[0] for s in shares)],
            "characters": [sum(s[1] for s in shares)],
        })

    # A rank for each slot; summed up before, so that a rank gets a few rows however many documents there are.
    world = spark.sparkContext.defaultParallelism
    share = F.pmod(F.xxhash64("doc_id", "n_chars"), F.lit(SHARES * world)).alias("share")
    sizes = table(spark, sf_dir, "documents").groupBy(share).agg(
        F.count(F.lit(1)).alias("documents"), F.sum("n_chars").alias("characters"))
    return run_per_rank(sizes, add_up, world, "documents bigint, characters bigint")


QUERIES = {
    "supervised_fit": fit,
    "save_load_model": saved_model,
    "batch_score": scores,
    "score_prompts": foreign_answers,
    "foreign_scores": foreign_document_scores,
    "run_per_rank": rank_sums,
}

SQL = {
    "supervised_fit": """
select count(*) as documents, true as no_worse_than_majority, true as in_range
from documents join labels using (doc_id)
where ('0x' || substr(md5(cast(doc_id as varchar)), 1, 8))::bigint % 5 = 0""",
    "batch_score": "select doc_id, true as in_range, true as prediction_follows from documents",
    "save_load_model": "select doc_id, true as same from documents join labels using (doc_id)",
    "score_prompts": f"""
with prompts as ({TEXT_SQL['generation_prompt']})
select example_id, array_to_string(list_filter(
  regexp_split_to_array(prompt, '\\s+'), lambda w: w <> '')[1:100], ' ') as answer,
  true as same, true as prediction_follows
from prompts""",
    "foreign_scores": "select doc_id, true as same from documents",
    "run_per_rank": """
select count(*) as documents, cast(sum(n_chars) as bigint) as characters from documents""",
}
