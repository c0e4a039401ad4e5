"""Token counts through a digest cache: only texts that no earlier run has seen are encoded."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from fitledger.llm.words import slices
from fitledger.session import broadcast_if_small, saved_table

# Contents of more rows than this are common: there is at most one for so many rows.
COMMON = 1_000
CACHE_SCHEMA = "content string, tokenizer string, n_tokens long"


def create_cache(spark: SparkSession, path: str) -> None:
    """An empty cache at ``path``, a folder that all executors reach; each append is a Parquet folder below it."""
    spark.createDataFrame([], CACHE_SCHEMA).write.parquet(f"{path}/append=0")


def tokenizer_digest(model_path: str) -> str:
    """Identifies the tokenizer's version: the SHA-256 of its file."""
    with open(model_path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def encoder(model_path: str):
    """A function from texts to token counts for a sentencepiece ``.model`` or a tokenizers ``.json``."""
    if model_path.endswith(".model"):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
        return lambda texts: [len(ids) for ids in processor.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(model_path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def count_tokens(documents: DataFrame, cache_path: str, model_path: str, id_column: str = "doc_id",
                 text_column: str = "text", limit: int = 4096) -> DataFrame:
    """One row (id, n_bytes, n_tokens, over_limit) for each document; new counts are appended to the cache.

    A text's normal form is the text itself with null made empty, because the models tell
    everything else apart; an empty text has what the library gives for it. Contents are
    known by their SHA-256 together with the tokenizer file's. Contents missing in the cache are
    encoded once each, whole, however many rows share them, one bounded slice of a batch at a time.
    Two jobs that append the same content do no harm: entries for one content are merged when read.
    Null ids and repeated rows stay as they are; an empty table gives no rows and appends none.
    """
    spark = documents.sparkSession
    version = tokenizer_digest(model_path)
    text = F.coalesce(F.col(text_column), F.lit(""))
    keyed = documents.select(F.col(id_column).alias(id_column), text.alias("text"),
                             F.sha2(text, 256).alias("content"))
    narrow = saved_table(
        keyed.select(id_column, F.octet_length("text").cast("long").alias("n_bytes"), "content"), "token-contents")
    # Contents of many rows are counted apart: their texts pass each task once, and their counts go to every task.
    common = saved_table(
        narrow.groupBy("content").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > COMMON).select("content"),
        "token-common")
    misses = (keyed.select("content", "text")
              .join(_stored(spark, cache_path, version), "content", "left_anti")
              .dropDuplicates(["content"]))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = encoder(model_path)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                counts = count(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("content"), pa.array([version] * len(counts)), pa.array(counts, pa.int64())],
                    ["content", "tokenizer", "n_tokens"])

    misses.mapInArrow(encode, CACHE_SCHEMA).write.parquet(f"{cache_path}/append={uuid.uuid4().hex}")
    stored = _stored(spark, cache_path, version)
    often = broadcast_if_small(saved_table(stored.join(broadcast_if_small(common), "content", "left_semi"), "token-often"))
    looked = narrow.join(often, "content", "left")
    rest = looked.where("n_tokens is null").drop("n_tokens").join(stored, "content")
    return looked.where("n_tokens is not null").unionByName(rest).select(
        id_column, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _stored(spark: SparkSession, path: str, version: str) -> DataFrame:
    # The folders are named one by one: Spark takes two scans of one folder for the same, also when it has grown between.
    cache = spark.read.schema(CACHE_SCHEMA).parquet(f"{path}/append=*")
    return (cache.where(F.col("tokenizer") == version)
            .groupBy("content").agg(F.min("n_tokens").alias("n_tokens")))
