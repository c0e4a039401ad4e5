"""Bulk scoring of whole tables, with MLlib models and with models from elsewhere."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DataType, DoubleType, StringType

# Fixed value: the most tokens an answer may add.
MAX_NEW_TOKENS = 100
# Rows that a foreign model is given at once.
BATCH_ROWS = 256


def batch_score(df: DataFrame, model: PipelineModel, id_column: str,
                keep: Sequence[str] = ()) -> DataFrame:
    """``id, prediction, score`` and the kept columns for every row; score is P(class 1)."""
    return model.transform(df).select(
        id_column, *keep,
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("score"),
    )


def foreign_scores(df: DataFrame, make_predict: Callable[[], Callable[[np.ndarray], np.ndarray]], id_column: str,
                   input_column: str, out: str = "score", out_type: DataType = DoubleType(),
                   batch_rows: int = BATCH_ROWS, keep: Sequence[str] = ()) -> DataFrame:
    """``id, out`` and the kept columns from any Python model.

    ``make_predict`` loads the model and returns a function from an array of inputs to an array of as many results. It
    runs once in each Python worker process, not for each task, and its batches cross the border as Arrow. A
    null input reaches the model as None.
    """
    predict = predict_batch_udf(make_predict, return_type=out_type, batch_size=batch_rows)
    return df.select(id_column, *keep, predict(F.col(input_column)).alias(out))


def score_prompts(df: DataFrame, make_model: Callable[[], Callable[[Sequence[str], int], Sequence[str]]],
                  id_column: str, prompt_column: str = "prompt",
                  max_new_tokens: int = MAX_NEW_TOKENS, keep: Sequence[str] = ()) -> DataFrame:
    """``id, answer`` and the kept columns from a model that answers prompts.

    ``make_model`` returns a function from a list of prompts and a token limit to the answers; it runs as in
    :func:`foreign_scores`.
    """
    def make_predict():
        model = make_model()
        return lambda prompts: np.array(model(list(prompts), max_new_tokens), dtype=object)

    return foreign_scores(df, make_predict, id_column, prompt_column, "answer", StringType(), keep=keep)
