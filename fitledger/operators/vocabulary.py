"""Token vocabulary: build it, encode with it, decode from it; length statistics."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from fitledger.operators.ordered import numbered
from fitledger.session import (
    MAX_BROADCAST_ROWS, broadcast_if_small, saved, saved_table, text_fits,
)

# Tokens that a task's summary holds at least.
SUMMARY = 1 << 15
# List elements that are coded, joined and replaced together.
CHUNK = 1 << 20
# Token lists that a summary is given at once.
LISTS, BATCH_ROWS = 1_000, "spark.sql.execution.arrow.maxRecordsPerBatch"
UNKNOWN_ID = -1
UNKNOWN_TOKEN = "<unk>"


def build_vocabulary(df: DataFrame, size: int | None = None, tokens_column: str = "tokens") -> DataFrame:
    """``token, n, token_id`` of all tokens, or of the ``size`` most frequent, ties by token.

    Types are numbered by ranges of (frequency, token), so a frequency that most types
    share is dealt over many tasks. With a ``size`` the types of frequencies that
    can't be among the first are left out before: a histogram of the frequencies tells.
    """
    # Filtered on the output: a filter below would split the text again.
    words = df.select(F.explode_outer(tokens_column).alias("token"))
    counts = words.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter(F.col("token").isNotNull())
    if size is not None:
        counts = saved_table(counts, "token-counts")
        higher = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
        # Every frequency has at least one type, so `size` frequencies always suffice.
        classes = saved(
            counts.groupBy("n").agg(F.count(F.lit(1)).alias("types"))
            .orderBy(F.desc("n")).limit(size)
            .select("n", F.coalesce(F.sum("types").over(higher), F.lit(0)).alias("first_id"))
            .filter(F.col("first_id") < size).select("n")
        )
        counts = counts.join(broadcast_if_small(classes), "n")
    ids = numbered(counts.select("token", "n"), [F.desc("n"), F.asc("token")], "token_id", "vocabulary")
    return ids if size is None else ids.filter(F.col("token_id") < size)


def frequent_words(df: DataFrame, size: int, tokens_column: str = "tokens", counters: int | None = None) -> DataFrame:
    """``token, n, token_id`` of the ``size`` most frequent tokens, ties by token, without shuffling all types.

    Each task keeps a summary of at most ``counters`` tokens: when there are more, the same amount is taken off all and what
    falls to zero goes. The amount that a task has taken off bounds what it has lost of any token, and the bounds add up
    over tasks. So a token's true count lies between the sum of its counters and that plus the bound, and one
    that can't reach the least of the ``size`` best lower limits isn't among the first. The others are counted again, exactly.
    If there are fewer summed tokens than asked for and something was taken off, the summaries can't
    tell, and the whole vocabulary is counted.
    """
    kept = counters or max(SUMMARY, 8 * size)
    summaries = _summaries(df.select(tokens_column), kept)
    totals = summaries.filter(F.col("token").isNotNull()).groupBy("token").agg(F.sum("n").alias("n"))
    totals = saved_table(totals, "word-limits")
    lost = summaries.agg(F.sum("lost")).first()[0] or 0
    best = totals.orderBy(F.desc("n"), "token").limit(size).agg(F.count(F.lit(1)), F.min("n")).first()
    if best[0] < size and lost:
        return build_vocabulary(df, size, tokens_column)
    least = best[1] if best[0] == size else 0
    candidates = saved_table(totals.filter(F.col("n") + F.lit(lost) >= least).select("token"), "word-candidates")
    words = df.select(F.explode_outer(tokens_column).alias("token"))
    counts = words.join(broadcast_if_small(candidates), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    # At most ``size`` rows are numbered.
    first = counts.orderBy(F.desc("n"), "token").limit(size)
    return first.withColumn("token_id", F.row_number().over(Window.orderBy(F.desc("n"), "token")).cast("bigint") - 1)


def _summaries(lists: DataFrame, kept: int) -> DataFrame:
    """All tasks' summaries, written. Lists reach Python some at a time: 10,000 long ones at once, Spark's own number,
    would be what a task's memory goes to."""
    settings = lists.sparkSession.conf
    before = settings.get(BATCH_ROWS)
    settings.set(BATCH_ROWS, min(int(before), LISTS) if int(before) > 0 else LISTS)
    try:
        return saved_table(lists.mapInArrow(_summary(kept), "token string, n bigint, lost bigint"), "word-summaries")
    finally:
        settings.set(BATCH_ROWS, before)


def _summary(kept: int):
    """A task's token counters, and one row with what was taken off."""
    def summarise(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counts, lost = pa.table({"token": pa.array([], pa.string()), "n": pa.array([], pa.int64())}), 0
        for batch in batches:
            words = batch.column(0).flatten()
            seen = words.drop_null().value_counts()
            new = pa.table({"token": seen.field("values").cast(pa.string()), "n": seen.field("counts")})
            counts = pa.concat_tables([counts, new]).group_by("token").aggregate([("n", "sum")]).rename_columns(["token", "n"])
            if len(counts) > kept:
                n = counts["n"].to_numpy()
                off = int(-np.partition(-n, kept)[kept])
                lost += off
                counts = pa.table({"token": counts["token"], "n": pa.array(n - off)}).filter(pa.array(n > off))
        counts = counts.append_column("lost", pa.array([0] * len(counts), pa.int64()))
        yield from counts.combine_chunks().to_batches()
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.string()), pa.array([0], pa.int64()), pa.array([lost], pa.int64())], ["token", "n", "lost"])

    return summarise


def encode(df: DataFrame, vocabulary: DataFrame, id_column: str, tokens_column: str = "tokens",
           max_words: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``id, ids``: token lists as id lists; tokens outside the vocabulary get -1.

    Each row gives one row: null lists stay null, and rows that share an id stay apart.
    The vocabulary goes to every executor when it has at most ``max_words`` words
    of bounded total length, and whole Arrow batches are looked up with no shuffle.
    A larger one is joined. Pass a vocabulary that is already saved: it is measured first.
    """
    words = vocabulary.select(F.col("token").alias("key"), F.col("token_id").alias("value"))
    return _replaced(df, words, text_fits(words, "key", max_words), id_column, tokens_column,
                     UNKNOWN_ID, "ids", "array<bigint>")


def decode_ids(df: DataFrame, vocabulary: DataFrame, id_column: str, ids_column: str = "ids",
               max_words: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``id, text`` from id lists; unknown ids become a marker, a null list a null text."""
    words = vocabulary.select(F.col("token_id").alias("key"), F.col("token").alias("value"))
    tokens = _replaced(df, words, text_fits(words, "value", max_words), id_column, ids_column,
                       UNKNOWN_TOKEN, "tokens", "array<string>")
    return tokens.select(id_column, F.array_join("tokens", " ").alias("text"))


def _replaced(df: DataFrame, words: DataFrame, fits: bool, id_column: str, list_column: str,
              unknown, out: str, out_type: str) -> DataFrame:
    way = _look_up if fits else _join_words
    return way(df, words, id_column, list_column, unknown, out, out_type)


def _look_up(df: DataFrame, words: DataFrame, id_column: str, list_column: str,
             unknown, out: str, out_type: str) -> DataFrame:
    """Replace every list element by the value of its key, a batch at a time."""
    shared = df.sparkSession.sparkContext.broadcast(words.select("key", "value").toArrow())
    label = uuid.uuid4().hex
    id_type = dict(df.dtypes)[id_column]

    def replace(batches):
        import pyarrow as pa

        # Indexed once in each worker process; a batch asks for each of its different words once.
        place, values = _index(label, shared)
        for batch in batches:
            lists = batch.column(1)
            coded = lists.flatten().dictionary_encode()
            known = pa.array([place.get(word) for word in coded.dictionary.to_pylist()], pa.int64())
            found = values.take(known.take(coded.indices)).fill_null(unknown)
            yield pa.RecordBatch.from_arrays([batch.column(0), _refilled(lists, found)], [id_column, out])

    return df.select(id_column, list_column).mapInArrow(
        replace, f"`{id_column}` {id_type}, {out} {out_type}")


# The latest index of this worker process, by its label.
_INDEXES: dict = {}


def _index(label: str, shared):
    if label not in _INDEXES:
        _INDEXES.clear()
        place = {key: i for i, key in enumerate(shared.value["key"].to_pylist())}
        _INDEXES[label] = place, shared.value["value"].combine_chunks()
    return _INDEXES[label]


def _refilled(lists, elements):
    """An Arrow array of lists as long as these, null where these are, with other elements."""
    import pyarrow as pa
    import pyarrow.compute as pc

    ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(lists), 0).cast(pa.int32()))
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
    return pa.ListArray.from_arrays(offsets, elements, mask=lists.is_null())


def _join_words(df: DataFrame, words: DataFrame, id_column: str, list_column: str,
                unknown, out: str, out_type: str) -> DataFrame:
    """The same by a join: rows are held in chunks, and each chunk's different elements are joined once.

    Lists become places in their chunk's dictionary, the dictionaries are joined with the words, and each chunk meets its
    own dictionary again. So what is shuffled are the different elements of each chunk and lists of small numbers, and a
    task holds one chunk at a time.
    """
    id_type, key_type = dict(df.dtypes)[id_column], dict(words.dtypes)["key"]
    rows = df.select(F.col(id_column).alias("id"), F.col(list_column).alias("list"))
    # Written out, so that a chunk is the same whenever it is read.
    coded = saved_table(rows.mapInArrow(
        _in_chunks(CHUNK), f"chunk bigint, id {id_type}, codes array<int>, code int, key {key_type}"), "coded-lists")
    found = coded.filter(F.col("code").isNotNull()).select("chunk", "code", "key").join(words, "key", "left").select(
        F.col("chunk").alias("of"), "code", F.coalesce("value", F.lit(unknown)).alias("value"))
    lists = coded.filter(F.col("code").isNull()).select("chunk", "id", "codes")

    def refill(lists, found):
        import pyarrow as pa

        code = found["code"].to_numpy()
        place = np.zeros(int(code.max()) + 1 if len(code) else 0, np.int64)
        place[code] = np.arange(len(code))
        codes = lists["codes"].combine_chunks()
        elements = found["value"].combine_chunks().take(pa.array(place)).take(codes.flatten()).fill_null(unknown)
        return pa.table({id_column: lists["id"].combine_chunks(), out: _refilled(codes, elements)})

    return lists.groupBy("chunk").cogroup(found.groupBy("of")).applyInArrow(
        refill, f"`{id_column}` {id_type}, {out} {out_type}")


def _in_chunks(elements: int):
    """Rows (id, list) as chunks of some ``elements``: rows with lists of codes, and rows with what the codes stand for."""
    def code(batches: Iterator) -> Iterator:
        import pyarrow.compute as pc
        from pyspark import TaskContext

        # The task's number in the upper bits.
        held, size, chunk = [], 0, TaskContext.get().partitionId() << 33
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            ends = size + np.cumsum(lengths.astype(np.int64) + 1)
            cuts = np.flatnonzero(np.diff(ends // elements, prepend=0)).tolist()
            for k, (start, end) in enumerate(zip([0, *cuts], [*cuts, batch.num_rows])):
                if k and held:
                    yield from _coded(held, chunk)
                    held, chunk = [], chunk + 1
                if end > start:
                    held.append(batch.slice(start, end - start))
            size = int(ends[-1] % elements) if len(ends) else size
        if held:
            yield from _coded(held, chunk)

    return code


def _coded(held: list, chunk: int) -> Iterator:
    import pyarrow as pa

    rows = pa.Table.from_batches(held)
    lists = rows.column(1).combine_chunks()
    coded = lists.flatten().dictionary_encode()
    n, id_type, key_type = len(coded.dictionary), rows.schema.field(0).type, coded.dictionary.type
    names = ["chunk", "id", "codes", "code", "key"]
    yield pa.RecordBatch.from_arrays([
        pa.array(np.full(len(rows), chunk)), rows.column(0).combine_chunks(), _refilled(lists, coded.indices),
        pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), key_type)], names)
    yield pa.RecordBatch.from_arrays([
        pa.array(np.full(n, chunk)), pa.nulls(n, id_type), pa.nulls(n, pa.list_(pa.int32())),
        pa.array(np.arange(n, dtype=np.int32)), coded.dictionary], names)


def length_profile(df: DataFrame, caps: Sequence[int], percentiles: Sequence[float] = (0.5, 0.9, 0.99),
                   length_column: str = "n_tokens") -> DataFrame:
    """One row: examples, tokens, exact percentiles, and how many examples each cap would cut.

    Everything is read off a histogram of the lengths, so the shuffle carries one
    row per distinct length and task.
    """
    length, n = F.col(length_column), F.col("n")
    histogram = df.groupBy(length_column).agg(F.count(F.lit(1)).alias("n"))
    return histogram.agg(
        F.sum(n).alias("examples"),
        F.sum(length * n).cast("bigint").alias("tokens"),
        F.max(length).cast("bigint").alias("longest"),
        *[F.percentile(length, p, n).alias(f"p{round(p * 100)}") for p in percentiles],
        *[F.sum(F.when(length > cap, n).otherwise(0)).alias(f"over_{cap}") for cap in caps],
    )

