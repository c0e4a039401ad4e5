"""A corpus pipeline over documents: quality, language, near-duplicates, benchmark leaks, source mix.

``STAGES`` are (name, function) pairs. Each function takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and read again as the next stage's docs. All but the last return the columns of docs,
also columns that bear the names of what an operator adds. Every stage reads whole texts and decides row by
row (near-duplicates: group by group), so rows that repeat are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fitledger.llm.decontaminate import benchmark_hits
from fitledger.llm.language import UNKNOWN, fit_language, least_score, predict_language
from fitledger.llm.mixing import mix
from fitledger.llm.near_dup import near_duplicates
from fitledger.llm.quality import THRESHOLD, fit_quality, score_quality
from fitledger.session import broadcast_if_small, saved_table

# A document whose score is below this part of what nearly all rightly labelled documents reach is in no language.
LANGUAGE_MARGIN = 0.8


# Documents that cross to Python and back at once: a few MB, and not as many tens of MB in each task of an executor.
ARROW_ROWS = "1000"


def _packed(docs: DataFrame) -> DataFrame:
    """The text, and all other columns in a struct, so that no name clashes with what an operator adds."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("_doc"), "text")


def _unpacked(kept: DataFrame, docs: DataFrame) -> DataFrame:
    return kept.select("_doc.*", "text").select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the quality classifier, fitted on the labels, does not reject.

    Null and empty texts are scored like others, by the classifier's bias. Without a usable label (none, or only
    null or conflicting ones) there is no classifier and all documents stay.
    """
    weights = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if not weights.any():
        return docs
    scored = score_quality(_packed(docs), weights, ["_doc"], keep_text=True)
    return _unpacked(scored.where(F.col("score") >= THRESHOLD), docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that the corpus names; a null or empty text, or one without letters, is in none.

    The score that a document needs is taken from all documents of the fold that the network was not fitted on. Where
    the corpus names no language to learn, all documents stay, those without letters, too.
    """
    network = fit_language(docs)
    if network is None:
        return docs
    # Written out: the threshold is read off the predictions that it is then applied to.
    predicted = saved_table(predict_language(_packed(docs), network, ["_doc"], keep_text=True), "language")
    needed = LANGUAGE_MARGIN * least_score(predicted.select("_doc.doc_id", "_doc.lang", "lang_pred", "score"), network)
    kept = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= needed)
    return _unpacked(predicted.where(kept), docs)


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near-duplicates (80 % of the shingles of five words): that with the least id.

    Null ids come last. Of rows that repeat the least id one stays. Texts without words are in no group and stay.
    """
    # A written number for each row, so that rows are linked and chosen whatever their ids.
    rows = saved_table(_packed(docs).withColumn("_row", F.monotonically_increasing_id()), "near-rows")
    found = saved_table(near_duplicates(rows, "_row").select("_row", "component_id", "kept"), "near-groups")
    groups = found.where(~F.col("kept")).select("component_id").distinct()
    members = found.join(broadcast_if_small(groups), "component_id").join(
        rows.select("_row", F.col("_doc.doc_id").alias("id")), "_row")
    members = saved_table(members.select("_row", "component_id", "id"), "near-members")
    first = members.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "_row")).alias("first"))
    gone = members.join(first.select("first._row"), "_row", "left_anti").select("_row")
    return _unpacked(rows.join(gone, "_row", "left_anti"), docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents without a window of benchmark words; null and empty texts have none. An empty benchmark keeps all."""
    hits = benchmark_hits(_packed(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), ["_doc"], keep_text=True)
    return _unpacked(hits.where(F.size("hits") == 0), docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes; documents that it leaves out go, and so do texts without words.

    A null source is a source like others. Of rows with equal ids and sizes any may be the one that is taken.
    """
    return mix(docs).where("taken > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("language ID", language),
    ("MinHash near-dedup", near_duplicate_groups),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing sources to target weights", source_mix),
]

# Two of the stages are fitted models, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the documents table; every stage is written before the next begins."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved_table(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
