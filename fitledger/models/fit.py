"""Supervised training on labelled text with MLlib."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.sql import DataFrame, functions as F

from fitledger.functions.tokens import TOKEN_BREAK
from fitledger.session import scratch_path


def supervised_fit(df: DataFrame, label_column: str, text_column: str = "text",
                   features: int = 1 << 16, iterations: int = 20, tree_depth: int = 2) -> PipelineModel:
    """Fit a linear classifier; gradients are summed over the executors in a tree.

    The text is tokenized and hashed once: the features are kept on disk for the
    two passes that precede the iterations, which run on the classifier's own
    cached blocks. With thousands of partitions a deeper tree relieves the driver.
    """
    labelled = df.select(text_column, F.col(label_column).cast("double").alias("label"))
    preparation = PipelineModel(stages=[
        # The same tokens as everywhere else: case is kept.
        RegexTokenizer(inputCol=text_column, outputCol="words", pattern=TOKEN_BREAK, toLowercase=False),
        HashingTF(inputCol="words", outputCol="features", numFeatures=features),
    ])
    prepared = preparation.transform(labelled).select("features", "label")
    prepared = prepared.persist(StorageLevel.DISK_ONLY)
    try:
        fitted = LogisticRegression(
            maxIter=iterations, regParam=0.01, aggregationDepth=tree_depth).fit(prepared)
    finally:
        prepared.unpersist()
    # As it is loaded again: a fitted model's training summary holds the session, which can't go to
    # tasks any more once some query of the session has observed its rows.
    path = scratch_path(df.sparkSession, "fitted")
    fitted.write().save(path)
    return PipelineModel(stages=[*preparation.stages, LogisticRegressionModel.load(path)])


def save_model(model: PipelineModel, path: str) -> None:
    """Weights and tokenizer settings in one folder."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
