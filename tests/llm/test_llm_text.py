"""Quality, language, token counts, decontamination."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from fitledger.llm import language, quality, token_counts, words
from fitledger.llm.decontaminate import benchmark_hits, contamination
from fitledger.llm.queries import QUERIES
from fitledger.session import scratch_path

SF = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, n_words long, hits string"
ODD = [(None, "a b c", None, None, None, None, None, "clash"), (1, None, "en", None, 0, 0.5, 1, None),
       (2, "", "en", "s", 0, None, None, None), (3, " \t\n", None, None, None, None, None, None),
       (4, "word " * 30_000, "en", None, None, None, None, None), (4, "word " * 30_000, "en", None, None, None, None, None),
       (5, "x" * 200_000, "en", None, None, None, None, None), (6, "€ ¿ñÑ 😀 123 !!!", "es", None, None, None, None, None)]


def test_words_against_regex():
    import re

    texts = ["", None, " a  Bç\x0bD ", "x", "É1-2", "   ", "tail "]
    data, starts, ends, hashes, firsts = words.words(pa.array(texts), ~words.is_space())
    got = [data[s:e].tobytes().decode() for s, e in zip(starts, ends)]
    each = [re.findall("[^\x20\x09-\x0d]+", (t or "")) for t in texts]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    assert got == [w.translate(lower) for ws in each for w in ws]
    assert np.diff(firsts).tolist() == [len(ws) for ws in each]
    assert len(set(hashes.tolist())) == len(set(got))


def test_quality_on_held_out_documents(spark):
    scored = QUERIES["op5_quality_scores"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality is not null")
    got = scored.where("held_out").join(labels, "doc_id").select("quality", "predicted", "score").toPandas()
    assert (got.quality == got.predicted).mean() > 0.98
    assert got[got.quality == 1].predicted.mean() > 0.98
    ids = scored.select("doc_id", "held_out").toPandas()
    assert all((zlib.crc32(str(i).encode()) % 4 == 2) == h for i, h in zip(ids.doc_id, ids.held_out))
    assert len(ids) == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    weights = quality.fit_quality(docs, labels)        # nothing to learn: conflicting, null
    got = quality.score_quality(docs, weights).collect()
    assert len(got) == len(ODD) and {r.score for r in got} == {0.5}
    known = spark.createDataFrame([(3, 0), (4, 1), (5, 1), (6, 0)], "doc_id long, quality int")
    got = quality.score_quality(docs, quality.fit_quality(docs, known), ["doc_id", "score", "text"][:1]).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert quality.score_quality(docs.limit(0), weights).count() == 0


@pytest.mark.parametrize("rows", [1, 10**6, 10**11, 10**15, 1 << 62])
def test_draws_at_any_size(rows):
    from fitledger.llm.sampling import HASH_SPAN, threshold

    expected = min(1.0, 600 / rows)
    assert threshold(600, rows) / HASH_SPAN == pytest.approx(expected, rel=1e-3 if rows < 1 << 61 else 1)
    assert threshold(600, rows) >= 1


def test_draws_from_many_rows(spark):
    """Counts of 10**11 rows leave a chance above zero; the hash decides."""
    from fitledger.llm.sampling import drawn

    few = spark.range(200_000).select(F.xxhash64("id").alias("h")).where(drawn(F.col("h"), 600, F.lit(200_000))).count()
    assert 450 < few < 750
    least = spark.range(1).select(drawn(F.lit(1 << 20), 600, F.lit(10**15)).alias("in"), drawn(F.lit(1 << 62), 600, F.lit(10**11)).alias("out")).first()
    assert least["in"] and not least["out"]


def test_repeated_ids_do_not_fill_the_sample(spark, monkeypatch):
    monkeypatch.setattr(language, "train", lambda texts, labels: texts)
    rows = [(5, "same text", "en")] * 4000 + [(5, f"other {i}", "en") for i in range(4000)] + [(i, f"text {i}", "fr") for i in range(6, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    bodies = language.fit_language(docs, limit=300, held_out_fold=-1)
    assert bodies.count(b"same text") <= 1 and 80 < len([b for b in bodies if b.startswith(b"other")]) < 300
    assert len([b for b in bodies if b.startswith(b"text")]) == 54
    labels = spark.createDataFrame([(5, 1), (6, 0)], "doc_id long, quality int")
    found = quality.training_rows(docs, labels, folds=1000).collect()
    assert sorted(r.quality for r in found) == [0, 1]


def test_least_score_is_that_of_its_rank_among_all_held_out_rows(spark):
    rows = [(i, "en" if i % 5 else "de", "en" if i % 7 else "de", (i * 7919 % 60_000) / 60_000) for i in range(60_000)]
    odd = [(None, "en", "en", 0.0), (1, None, "en", 0.0), (1, "xx", "xx", 0.0), (1, "und", "und", 0.0)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, lang string, lang_pred string, score double").repartition(7)
    net = language.fresh(["de", "en", language.OTHER])
    right = sorted(s for i, truth, guess, s in rows if zlib.crc32(str(i).encode()) % 3 == 1 and truth == guess)
    assert language.least_score(docs, net) == right[-(-len(right) // 1000) - 1]
    assert language.least_score(docs, net, quantile=0.5) == right[-(-len(right) // 2) - 1]
    assert language.least_score(docs.where("doc_id = 1 and score = 0"), net, quantile=1e-9) == 0.0
    assert language.least_score(docs.limit(0), net) == 0.0


def test_many_languages(spark, monkeypatch):
    monkeypatch.setattr(language, "train", lambda texts, labels: sorted(labels))
    rows = [(i, f"text {i}", f"l{i % 500}") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.fit_language(docs, held_out_fold=-1, max_languages=200)
    assert len(set(got)) == 200 and got.count("l0") == 3


M, MASK = 0x9E3779B97F4A7C15 | 1, (1 << 64) - 1


def _mixed(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def _plain_quality(text, weights):
    """The score of one text, token by token, in plain Python."""
    data, tokens = (text or "").encode(), []
    kind = lambda b: (quality.BREAK if b == 10 else quality.SPACE if b == 32 or 9 <= b <= 13 else
                      quality.WORD if b >= 128 or chr(b).isalnum() else quality.MARK)
    for b in data:
        if tokens and tokens[-1][0] == kind(b):
            tokens[-1][1].append(b)
        else:
            tokens.append((kind(b), [b]))
    tokens = [(k, bytes(t)) for k, t in tokens if k != quality.SPACE]
    words, shapes = [], []
    for i, (k, t) in enumerate(tokens):
        words.append(_mixed(sum((b + 1) * pow(M, j, 1 << 64) for j, b in enumerate(t.lower() if t.isascii() else bytes(
            c + 32 if 65 <= c <= 90 else c for c in t))) & MASK))
        upper, digits = [65 <= b <= 90 for b in t], sum(48 <= b <= 57 for b in t)
        form = 4 if digits else 0 if not any(upper) else 2 if all(upper) and len(t) > 1 else 1 if sum(upper) == 1 and upper[0] else 3
        form = form * 8 + sum(len(t) >= edge for edge in (2, 4, 7, 12, 24))
        again = sum(back * (i >= back and words[i - back] == words[i]) for back in (1, 2))
        shapes.append(_mixed(form * 4 + again) if k == quality.WORD else words[i] ^ again)
    total = float(weights[0])
    for salt, (stream, n) in enumerate(((words, 1), (words, 2), (shapes, 1), (shapes, 2), (shapes, 3)), 1):
        grams = []
        for i in range(len(stream) - n + 1):
            h = stream[i]
            for other in stream[i + 1:i + n]:
                h = _mixed((h * M + other) & MASK)
            grams.append(max(1, _mixed((h + salt) & MASK) >> 64 - quality.BITS))
        total += sum(float(weights[g]) for g in grams) * quality.VALUE / max(len(stream) - n + 1, 1)
    return 1 / (1 + np.exp(-min(30, max(-30, total))))


def test_quality_query_against_plain_scores(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    weights = quality.fit_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect() if len(r.text or "") < 6000}
    got = {r.doc_id: r for r in QUERIES["op5_quality_scores"](spark, sf).collect()}
    assert len(got) == docs.count() and len(texts) > 100
    for i, text in texts.items():
        assert got[i].score == pytest.approx(_plain_quality(text, weights), abs=1e-6), i
        assert got[i].predicted == int(got[i].score >= 0.7)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)


def test_scores_do_not_depend_on_neighbours():
    weights = np.random.default_rng(1).normal(size=1 << quality.BITS).astype(np.float32)
    texts = ["same word", "word same", "", "word", "word word", None, "!! !!", "!!"]
    together = quality.dot_products(pa.array(texts), weights)
    alone = [quality.dot_products(pa.array([t], pa.string()), weights)[0] for t in texts]
    assert together == pytest.approx(alone, abs=1e-6)


def _plain_language(net, text):
    """Mean label probabilities of one text, byte by byte, in both directions."""
    data, hidden = text.encode(), net.recurrent.shape[1]
    gate = lambda x: 1 / (1 + np.exp(-x))
    total = np.zeros(len(net.languages))
    for start in range(0, len(data), language.STRETCH):
        part, ways = data[start:start + language.STRETCH], []
        for way in (0, 1):
            h, seen = np.zeros(hidden), []
            for b in part[::-1] if way else part:
                add, rec = net.table[way][b].astype(float), h @ net.recurrent[way].astype(float)
                z, r = gate(add[:hidden] + rec[:hidden]), gate(add[hidden:2 * hidden] + rec[hidden:2 * hidden])
                n = np.tanh(add[2 * hidden:] + r * rec[2 * hidden:])
                h = n + z * (h - n)
                seen.append(h)
            ways.append(seen[::-1] if way else seen)
        for a, b in zip(*ways):
            e = np.exp(a @ net.output[0] + b @ net.output[1] + net.bias)
            total += e / e.sum()
    return total / max(1, len(data))


def test_language_query_against_plain_labels(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    net = language.fit_language(docs)
    got = {r.doc_id: r for r in QUERIES["op7_language_predictions"](spark, sf).collect()}
    assert len(got) == docs.count()
    some = [r for r in docs.select("doc_id", "text").collect() if len(r.text or "") < 1200][:60]
    for r in some:
        p = _plain_language(net, r.text or "")[:len(net.learnt())]
        if any(c.isalpha() for c in r.text or ""):
            assert got[r.doc_id].lang_pred == net.learnt()[int(p.argmax())] and got[r.doc_id].score == pytest.approx(p.max(), abs=1e-3)
        else:
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)


def test_dot_products_are_sums_of_features():
    column = pa.array(["Some text, SOME text.\nAnd more 12", None, "", "a a a a"])
    weights = np.random.default_rng(0).normal(size=1 << quality.BITS).astype(np.float32)
    slow = [float(weights[s] @ v) for s, v in quality.features(column)]
    assert quality.dot_products(column, weights) == pytest.approx(slow, abs=1e-4)


def test_language_on_held_out_documents(spark):
    predicted = QUERIES["op7_language_predictions"](spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").where("lang is not null")
    got = predicted.where("held_out").join(truth, "doc_id").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.96
    assert got.score.between(0, 1).all()


def test_language_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    more = spark.createDataFrame([(i, "words of a language", "en", None, 0, None, None, None) for i in range(20, 30)], DOCS)
    net = language.fit_language(docs.unionByName(more), steps=5)
    got = language.predict_language(docs, net).collect()
    assert len(got) == len(ODD)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    assert {r.lang_pred for r in got if r.doc_id in (4, 5)} <= set(net.languages)
    empty = docs.limit(0)
    assert language.fit_language(empty) is None
    assert {r.lang_pred for r in language.predict_language(docs, None).collect()} == {"und"}
    assert language.predict_language(empty, None).count() == 0


def test_language_is_learnt_from_all_parts_of_a_text(spark, monkeypatch):
    monkeypatch.setattr(language, "train", lambda texts, labels: texts)
    rows = [(i, "a" * 4096 + "b" * 8192 + "c" * 4096, "en") for i in range(200)] + [(300 + i, "é", "fr") for i in range(9)]
    bodies = language.fit_language(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {len(b) for b in bodies} == {2, 4096}
    assert {chr(c) for b in bodies for c in b if c < 128} == set("abc")


def test_gradients_against_differences():
    net = language.fresh(["a", "b", "c"], 4)
    for name in ("table", "recurrent", "output", "bias"):
        setattr(net, name, getattr(net, name).astype(float))
    symbols = np.random.default_rng(0).integers(0, 256, (7, 3))
    symbols[5:, 1] = language.PADDING
    labels = np.array([0, 2, 1])
    for weights, slope in zip(net.parameters(), language.gradients(net, symbols, labels)[1]):
        at = np.unravel_index(np.argmax(np.abs(slope)), slope.shape)
        sides = []
        for step in (1e-2, -2e-2):
            weights[at] += step
            sides.append(language.gradients(net, symbols, labels)[0])
        weights[at] += 1e-2
        assert (sides[0] - sides[1]) / 2e-2 == pytest.approx(slope[at], rel=1e-3)


def test_padding_changes_nothing():
    net = language.fresh(["a", "b"])
    texts = ["abc", "x" * 300, "", "défg" * 40]
    together = language.document_probabilities(net, pa.array(texts))
    alone = np.concatenate([language.document_probabilities(net, pa.array([t])) for t in texts])
    assert together == pytest.approx(alone, abs=1e-5)
    assert together.sum(axis=1) == pytest.approx([1, 1, 0, 1], abs=1e-4)


@pytest.mark.parametrize("model", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_token_counts_and_cache(spark, model):
    path = public_tokenizers.path(model)
    rows = ODD + [(7, "<s> hello </s> <unk>", None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    cache = scratch_path(spark, "test-cache")
    token_counts.create_cache(spark, cache)
    count = token_counts.encoder(path)
    expected = sorted(((r[0], len((r[1] or "").encode()), n, n > 4096)
                       for r, n in zip(rows, count([r[1] or "" for r in rows]))), key=str)
    for _ in range(2):
        got = sorted((tuple(r) for r in token_counts.count_tokens(docs, cache, path).collect()), key=str)
        assert got == expected
        assert spark.read.parquet(cache).count() == len({r[1] or "" for r in rows})     # the second run adds none
    assert token_counts.count_tokens(docs.limit(0), cache, path).count() == 0


def test_cached_counts_are_found(spark):
    """What an earlier call has stored is taken, not encoded again: a planted count comes back."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    cache = scratch_path(spark, "test-cache")
    token_counts.create_cache(spark, cache)
    docs = spark.createDataFrame([(i, f"text {i % 3}", None, None, None, None, None, None) for i in range(5000)], DOCS)
    planted = [(hashlib.sha256(b"text 1").hexdigest(), token_counts.tokenizer_digest(path), 777)]
    spark.createDataFrame(planted, token_counts.CACHE_SCHEMA).write.parquet(f"{cache}/append=planted")
    got = token_counts.count_tokens(docs, cache, path).collect()
    assert len(got) == 5000 and {r.doc_id % 3 for r in got if r.n_tokens == 777} == {1}
    assert sum(r.n_tokens == 777 for r in got) == 1667
    assert spark.read.parquet(cache).count() == 3


def test_piece_counts_are_the_library_s(spark):
    import sentencepiece

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas()
    processor = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    expected = dict(zip(docs.doc_id, map(len, processor.encode(list(docs.text)))))
    got = QUERIES["op9_token_counts"](spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: r.n_tokens for r in got} == expected


def _hit_words(text, items, window=10):
    import re

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    cut = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(lower))
    doc, hit, names = cut(text), set(), set()
    for name, body in items:
        other = cut(body)
        n = min(window, len(other))
        for i in range(len(other) - n + 1 if n else 0):
            for j in range(len(doc) - n + 1):
                if doc[j:j + n] == other[i:i + n]:
                    hit |= set(range(j, j + n))
                    names.add(str(name))
    return len(doc), len(hit), sorted(names)


@pytest.mark.parametrize("part_bytes", [1 << 20, 200])
def test_decontamination_against_brute_force(spark, part_bytes):
    long = " ".join(f"w{i}" for i in range(30))
    items = [(1, long), (2, "Tiny Item"), (3, "one"), (10, long), (4, ""), (5, None), (6, " ".join(["same"] * 12)),
             (7, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 other"), (1, long), (None, "null id words here")]
    texts = [None, "", "one", "ONE, two-tiny item", long, long.upper().replace(" ", " -\n"), "same " * 40,
             "w0 w1 w2 w3 w4 w5 w6 w7 w8 x", "a " * 5000 + long + " b" * 5000, "tiny", "item tiny", "w29 " + long[:40],
             "null id words here"]
    docs = spark.createDataFrame([(i, t, None, None, None, 1.0, 2, "x") for i, t in enumerate(texts)] * 2, DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = benchmark_hits(docs, bench, part_bytes=part_bytes).collect()
    assert len(got) == 2 * len(texts)
    named = [i for i in items if i[0] is not None]
    for r in got:
        n, hit, names = _hit_words(texts[r.doc_id], named)
        assert (r.n_words, sum(h.end - h.start for h in r.hits), r["items"]) == (n, hit, names), texts[r.doc_id]
    assert contamination(docs.limit(0), bench).count() == 0
    assert not any(r.contaminated for r in contamination(docs, bench.limit(0)).collect())
