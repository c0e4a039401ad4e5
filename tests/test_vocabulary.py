"""The vocabulary against a plain counter, and encoding by both ways."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from fitledger.functions import tokenize
from fitledger.operators import vocabulary
from fitledger.operators.vocabulary import build_vocabulary, decode_ids, encode, length_profile
from fitledger.session import saved, saved_table

TEXTS = ["a b a c", "", "b a d e f g", "zz y x w v u t", "a a a", "é ü 日本 a b", "one"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = list(enumerate(TEXTS))
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).select(
        "doc_id", tokenize(F.col("text")).alias("tokens"))


def ranked(texts):
    counts = Counter(t for text in texts for t in text.split())
    return sorted(counts.items(), key=lambda item: (-item[1], item[0]))


@pytest.mark.parametrize("size", [1, 2, 3, 5, 11, 100, None])
def test_ids_follow_count_then_token(docs, size):
    got = build_vocabulary(docs, size).collect()
    expected = [(t, n, i) for i, (t, n) in enumerate(ranked(TEXTS)[:size])]
    assert sorted(map(tuple, got), key=lambda r: r[2]) == expected


@pytest.mark.parametrize("max_words", [1_000, 1])
def test_encode_and_decode(docs, max_words):
    words = saved(build_vocabulary(docs, 6))
    ids = {t: i for i, (t, _) in enumerate(ranked(TEXTS)[:6])}
    encoded = encode(docs, words, "doc_id", max_words=max_words)
    got = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    assert got == {i: [ids.get(t, -1) for t in text.split()] for i, text in enumerate(TEXTS)}
    back = {r["doc_id"]: r["text"] for r in decode_ids(encoded, words, "doc_id", max_words=max_words).collect()}
    assert back == {
        i: " ".join(t if t in ids else "<unk>" for t in text.split()) for i, text in enumerate(TEXTS)}


def test_lookup_does_not_shuffle(docs, spark):
    words = saved(build_vocabulary(docs, 6))
    flat = spark.createDataFrame([(1, ["a"])], "doc_id bigint, tokens array<string>")
    plan = encode(flat, words, "doc_id")._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan


@pytest.mark.parametrize("max_words", [1_000, 1])
def test_rows_stay_apart_in_both_ways(spark, docs, max_words):
    """Null and empty lists, repeated and null ids, null words: one answer with and without a broadcast."""
    words = saved(build_vocabulary(docs))
    rows = [(1, None), (2, ["a"]), (3, []), (4, ["b", "a"]), (4, ["b", "a"]), (4, ["c"]), (None, ["a", None, "nowhere"])]
    ids = {t: i for i, (t, _) in enumerate(ranked(TEXTS))}
    some = spark.createDataFrame(rows, "doc_id bigint, tokens array<string>")
    encoded = encode(some, words, "doc_id", max_words=max_words)
    expected = [(i, None if ts is None else [ids.get(t, -1) for t in ts]) for i, ts in rows]
    assert sorted(map(tuple, encoded.collect()), key=repr) == sorted(expected, key=repr)
    back = decode_ids(encoded, words, "doc_id", max_words=max_words)
    texts = [(i, None if ts is None else " ".join(t if t in ids else "<unk>" for t in ts)) for i, ts in rows]
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(texts, key=repr)


@pytest.mark.parametrize("chunk", [1, 50, 1 << 20])
def test_a_large_vocabulary_is_joined_once_for_each_chunk(spark, monkeypatch, chunk):
    """Not every occurrence of a word is shuffled: what is written are the rows and each chunk's different words."""
    texts = [" ".join(f"w{(i * j) % 97}" for j in range(i % 60)) for i in range(600)] + ["w1 " * 5_000]
    words = saved(build_vocabulary(spark.createDataFrame(enumerate(texts), "doc_id bigint, text string").select(
        tokenize(F.col("text")).alias("tokens"))))
    some = spark.createDataFrame([(i % 7, t.split(), ) for i, t in enumerate(texts)], "doc_id bigint, tokens array<string>")
    written = []
    monkeypatch.setattr(vocabulary, "CHUNK", chunk)
    monkeypatch.setattr(vocabulary, "saved_table", lambda df, label: written.append(saved_table(df, label)) or written[-1])
    encoded = encode(some.repartition(3), words, "doc_id", max_words=1)
    back = decode_ids(encoded, words, "doc_id", max_words=1)
    assert sorted(map(tuple, back.collect())) == sorted((i % 7, " ".join(t.split())) for i, t in enumerate(texts))
    assert sorted(map(repr, encoded.collect())) == sorted(map(repr, encode(some, words, "doc_id").collect()))
    tokens = sum(len(t.split()) for t in texts)
    assert len(written) == 2 and (chunk < 97 or all(w.count() <= len(texts) + 3 * 97 < tokens / 10 for w in written))


def test_the_text_is_split_once(spark):
    for name in ("tokenize", "build_vocabulary"):
        plan = entry_points.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") <= 1


def test_length_profile(spark):
    lengths = [1, 2, 3, 4, 100]
    df = spark.createDataFrame([(n,) for n in lengths], "n_tokens int")
    row = length_profile(df, [3, 50], [0.5]).first()
    assert row.asDict() == {"examples": 5, "tokens": 110, "longest": 100, "p50": 3.0, "over_3": 2, "over_50": 1}
