"""Near-duplicates, nearest neighbours, mixing and the pipeline."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from fitledger.llm import mixing, near_dup
from fitledger.llm.near_dup import components, near_duplicates
from fitledger.llm.neighbours import hilbert, nearest
from fitledger.llm.queries import QUERIES
from fitledger.session import saved_table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, component_id string, kept string"


def _sets(texts, size):
    out = []
    for text in texts:
        w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
        out.append(frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset())
    return out


def _brute(ids, texts, size=5, percent=80):
    sets, parent = _sets(texts, size), {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                parent[max(root(ids[a]), root(ids[b]))] = min(root(ids[a]), root(ids[b]))
    return {i: (len(s), root(i), root(i) == i) for i, s in zip(ids, sets)}


@pytest.mark.parametrize("size, percent, band_rows", [(3, 85, 5), (5, 80, 4)])
def test_near_duplicates_against_brute_force(spark, size, percent, band_rows):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    texts = [None, "", " \n", "one", "ONE", "one two", "a b c", "a  b\tc", "x" * 100_000]
    for n, copies, edits in ((60, 60, 6), (200, 40, 15), (25, 20, 2), (8, 6, 1), (3000, 3, 40)):
        base = [word() for _ in range(n)]
        chain = list(base)
        for _ in range(copies):
            copy = list(base)
            for _ in range(rng.randint(0, edits)):
                copy[rng.randrange(n)] = word()
            texts.append(" ".join(copy))
            chain[rng.randrange(n)] = word()        # a chain that drifts away from its start
            texts.append(" ".join(chain))
    order = list(range(len(texts)))
    rng.shuffle(order)
    docs = spark.createDataFrame([(i, texts[i], None, "s", None, "clash", "clash") for i in order], DOCS)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(
        docs, shingle=size, percent=percent, band_rows=band_rows).collect()}
    assert got == _brute(list(range(len(texts))), texts, size, percent)


def test_common_counts_against_sets():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, n)) for n in (0, 1, 50, 5000, 8000, 8000, 300)]
    expected = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = near_dup.common_counts(sets)
    assert [[x for j, x in enumerate(row) if j != i] for i, row in enumerate(got.tolist())] == [
        [x for j, x in enumerate(row) if j != i] for i, row in enumerate(expected)]
    assert near_dup.common_counts(sets[:3], sets[3:]).tolist() == [row[3:] for row in expected[:3]]


@pytest.mark.parametrize("block, shingles", [(8, 1 << 19), (1 << 10, 900)])
def test_large_clusters_in_blocks(spark, monkeypatch, block, shingles):
    """Groups of some hundred near-copies in clusters of many blocks, linked by chains and hubs."""
    monkeypatch.setattr(near_dup, "BLOCK", block)
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", shingles)
    rng = random.Random(8)
    texts = []
    for n, copies, edits in ((60, 120, 9), (40, 60, 4), (90, 60, 3)):
        base = [f"{n}x{i}" for i in range(n)]
        chain = list(base)
        for _ in range(copies):
            copy = list(base)
            for _ in range(rng.randint(0, edits)):
                copy[rng.randrange(n)] = f"y{rng.random()}"
            chain[rng.randrange(n)] = f"z{rng.random()}"
            texts += [" ".join(copy), " ".join(chain)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    docs = spark.createDataFrame([(i, texts[i], None, "s", None, "clash", "clash") for i in order], DOCS)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, shingle=3, percent=85, band_rows=5).collect()}
    assert got == _brute(list(range(len(texts))), texts, 3, 85)


def test_many_unlike_near_copies_in_one_bucket(spark):
    """5,000 texts that share buckets and are not alike, and some that are alike to one of them."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(60)]

    def unlike(k):
        words = list(base)
        for at in rng.sample(range(60), 3):
            words[at] = f"{k}:{at}"
        return words

    texts = [unlike(k) for k in range(5000)]
    near = [texts[17][:-1] + ["end"], texts[17][:-2] + ["other", "end"], texts[4321][1:], texts[4321] + ["more"]]
    every = [" ".join(t) for t in texts + near]
    docs = spark.createDataFrame([(i, t, None, None, None, None, None) for i, t in enumerate(every)], DOCS)
    got = {r.doc_id: r.component_id for r in near_duplicates(docs, shingle=3, percent=85, band_rows=5).collect()}
    assert len(got) == 5004
    sample = [17, 4321, *range(5000, 5004), *rng.sample(range(5000), 60)]
    found = _brute(sample, [every[i] for i in sample], 3, 85)
    for i in sample:
        assert (got[i] == i) == (found[i][1] == i), i
    assert {got[5000], got[5001]} == {got[17]} and {got[5002], got[5003]} == {got[4321]}


def test_near_duplicates_of_medium_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in QUERIES["op6_near_duplicates"](spark, sf).collect()}
    assert got == _brute(list(docs.doc_id), list(docs.text), 3, 85)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(None, "p q r s"), (9, "p q r s"), (None, "alone here now"), (4, "t u v w"), (4, "t u v w"), (4, "z"), (None, None)]
    docs = spark.createDataFrame([(i, t, None, None, None, None, None) for i, t in rows], DOCS)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_duplicates(docs, shingle=3, percent=85).collect())
    assert got == sorted([("None", 2, "9", False), ("9", 2, "9", True), ("None", 1, "None", True), ("4", 2, "4", True),
                          ("4", 2, "4", True), ("4", 1, "4", True), ("None", 0, "None", True)])
    assert near_duplicates(docs.limit(0)).count() == 0


def test_near_duplicates_of_null_and_repeated_ids(spark):
    text = [f"w{i}" for i in range(60)]
    near, other = " ".join(text[:-1] + ["end"]), " ".join(f"v{i}" for i in range(60))
    rows = [(None, " ".join(text)), (7, near), (None, other), (None, other + " end"), (3, "p q r s"), (5, "p q r s"), (5, "t u v")]
    docs = spark.createDataFrame([(i, t, None, None, None, None, None) for i, t in rows], DOCS)
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in near_duplicates(docs).collect())
    assert got == sorted([("None", "7", False), ("7", "7", True), ("None", "None", True), ("None", "None", False),
                          ("3", "3", True), ("5", "3", False), ("5", "5", True)])


def test_components(spark):
    rng = random.Random(0)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(7, 7)]
    parent = {x: x for p in pairs for x in p}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {r.id: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(got.get(x, x) == root(x) for x in parent)


def test_components_take_few_rounds_and_write_few_files(spark, monkeypatch):
    """A chain of links, each in a task of its own, in any order of ids."""
    written, rng = [], random.Random(3)
    monkeypatch.setattr(near_dup, "saved_table", lambda df, label: written.append(df.rdd.getNumPartitions()) or saved_table(df, label))
    ids = rng.sample(range(10_000), 120)
    links = spark.createDataFrame(list(zip(ids, ids[1:])) + [(20_000, 20_001)], "a long, b long").repartition(60)
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 100)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r.id: r.component for r in components(links).collect()}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert got == dict.fromkeys(ids, min(ids)) | {20_000: 20_000, 20_001: 20_000}
    assert max(written) <= 2 * spark.sparkContext.defaultParallelism and len(written) <= 7, written


def test_forest_gives_the_least_of_each_component():
    u, v = near_dup.forest(np.array([5, 9, 7, 3, 8]), np.array([3, 7, 5, 3, 8]))
    assert dict(zip(u.tolist(), v.tolist())) == {5: 3, 7: 3, 9: 3}


def test_hilbert_neighbours_touch():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = hilbert(grid, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def _exact(ids, vectors, every=20, k=20):
    good = [(i, np.array(v, float)) for i, v in zip(ids, vectors)
            if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    size = max((len(v) for _, v in good), default=0)
    good = [(i, np.pad(v, (0, size - len(v)))) for i, v in good]
    out = {}
    for i, v in good:
        if i % every == 0:
            out[i] = sorted((-float(np.float64(v) @ w), j) for j, w in good if j != i)[:k]
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_against_brute_force(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").toPandas()
    truth = _exact(list(rows.vec_id), [list(map(float, v)) for v in rows.embedding])
    got = QUERIES["op3_nearest_vectors"](spark, f"/root/testdata/{sf}").toPandas()
    pairs = {(q, j) for q, best in truth.items() for _, j in best}
    assert len(pairs & set(zip(got.query_id, got.vec_id))) / len(pairs) >= 0.9
    assert (got.groupby("query_id").size() == 20).all()
    assert (got.sort_values(["query_id", "rank"]).groupby("query_id").score.apply(lambda s: s.is_monotonic_decreasing)).all()


def test_neighbours_of_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rng = np.random.default_rng(0)
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (40, [0.0, 2.0]), (60, None), (80, [0.0, 0.0]), (100, [nan, 1.0]),
            (120, [inf, 1.0]), (140, [None, 1.0]), (None, [1.0, 1.0]), (160, [3.0]), (180, [])]
    rows += [(i, [5.0, 5.0]) for i in range(200, 260)]          # one very common vector: ties to smaller ids
    rows += [(i, rng.normal(size=2).tolist()) for i in range(300, 340)]
    table = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<double>, rank string, score double")
    got = defaultdict(list)
    for r in nearest(table).orderBy("query_id", "rank").collect():
        got[r.query_id].append((-r.score, r.vec_id))
        assert r["rank"] == len(got[r.query_id])
    truth = _exact(*zip(*rows))
    assert set(got) == set(truth)
    for q in truth:
        assert got[q] == pytest.approx(truth[q]) if len(truth[q]) == 0 else [j for _, j in got[q]] == [j for _, j in truth[q]]
    assert len(nearest(table.where("vec_id in (0, 40)")).collect()) == 2       # fewer candidates than 20
    assert nearest(table.limit(0)).count() == 0


def test_flow_is_least_cost():
    a, b, c = "abc"
    patterns = [(frozenset([a]), 10), (frozenset([a, b]), 10), (frozenset([b]), 4), (frozenset([c]), 5), (frozenset([c]), 0)]
    # a needs 15, b 9: the shared pattern gives once to both, and nothing has to be repeated.
    assert mixing.min_cost_flow(patterns, {a: 15, b: 9, c: 12}) == [10, 10, 4, 12, 0]
    # More than all can give once: repeats are as even as they can be.
    given = mixing.min_cost_flow(patterns, {a: 30, b: 18, c: 99})
    assert sum(given[:3]) == 48 and given[3] == 15 and all(g <= 2 * s for g, (_, s) in zip(given[:3], patterns))


def test_targets_stop_at_three_times(spark):
    sizes = spark.createDataFrame([("x", 1000), (None, 30), ("z", 500), ("y", 10)], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    got = {s: got[s] for s in ("x", "y", "z", None)}
    assert got["y"] == 30 and sum(got.values()) == pytest.approx(1540)
    assert all(t <= 3 * s for t, s in zip(got.values(), (1000, 10, 500, 30)))


def test_mix_of_odd_rows(spark):
    rows = [(1, "a b c", None, "s1"), (1, "a b c", None, "s1"), (None, "x y", None, None), (2, None, None, "s2"),
            (3, "", None, "s2"), (4, " w ", None, ""), (5, "v " * 50_000, None, "s3"), (6, "q\x0br", None, "s3")]
    docs = spark.createDataFrame([(i, t, l, s, None, "x", "y") for i, t, l, s in rows], DOCS)
    got = mixing.mix(docs).collect()
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted(
        [("1", 3), ("1", 3), ("None", 2), ("2", 0), ("3", 0), ("4", 1), ("5", 50_000), ("6", 2)])
    by = defaultdict(list)
    for r in got:
        by[r.source_size, r.target].append(r)
        assert 0 <= r.taken <= 3 * r.size
    for (_, target), members in by.items():
        assert sum(r.taken for r in members) == round(target)
    assert sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()), key=str) == sorted(map(tuple, got), key=str)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mix_of_overlapping_sources(spark):
    rows = [(i, "w " * (1 + i % 7), [["p"], ["q"], ["p", "q"], ["q", "p", "p"], [], None][i % 6]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    got = mixing.mix(docs).collect()
    assert len(got) == 300 and all(0 <= r.taken <= 3 * r.size for r in got)
    assert abs(sum(r.taken for r in got) - sum(r.size for r in got)) <= 3


def _pipeline(spark, docs, sf):
    import corpus_pipeline

    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(stage(spark, steps[-1], sf).cache())
    return steps


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.01"
    docs, good, known, single, clean, mixed = _pipeline(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    for before, after in ((docs, good), (good, known), (known, single), (single, clean)):
        assert after.columns == docs.columns and after.exceptAll(before).count() == 0
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    gone = docs.join(good, "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.where("quality = 1").count() <= 2 and gone.where("quality = 0").count() > 20
    rows = known.toPandas()
    expected = {i for i, (_, _, kept) in _brute(list(rows.doc_id), list(rows.text)).items() if kept}
    assert {r.doc_id for r in single.select("doc_id").collect()} == expected
    assert clean.count() < single.count()
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == sorted(map(tuple, mixed.collect()))
    assert "pipeline" in entry_points.queries()


def test_pipeline_of_odd_rows(spark):
    """Nulls, empty and very long texts, repeated rows, and columns that bear the names of what operators add."""
    sf = "/root/testdata/sf0.001"
    known = spark.read.parquet(f"{sf}/documents.parquet")
    long = " ".join(known.where("lang = 'en'").limit(40).toPandas().text) * 3
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (None, "Odd text here.", None, None, None), (10**12, "", "en", None, 0),
         (10**12 + 1, "9 " * 50_000, "de", "s", 1), (10**12 + 2, long, "en", "s", 1)], known.schema)
    clashing = {c: F.lit(f"clash {c}") for c in ("score", "hits", "kept", "component_id", "lang_pred", "_row", "taken", "size", "_text")}
    docs = known.unionByName(odd).unionByName(odd).withColumns(clashing)
    steps = _pipeline(spark, docs, sf)
    for before, after in zip(steps[:-1], steps[1:-1]):
        assert after.columns == docs.columns and after.exceptAll(before).count() == 0
        assert after.where("score <> 'clash score' or kept <> 'clash kept' or _text <> 'clash _text'").count() == 0
    good, known_language, single, clean, mixed = ({r.doc_id: r for r in step.select("doc_id").collect()} for step in steps[1:])
    assert not {10**12, 10**12 + 1} & set(known_language)               # no letters: in no language
    ids = [r.doc_id for r in steps[3].where("doc_id is not null").select("doc_id").collect()]
    assert len(ids) == len(set(ids))                                      # repeated rows: one stays
    assert set(mixed) <= set(clean) <= set(single) <= set(known_language) <= set(good)
    assert all(r.taken > 0 and r.size > 0 for r in steps[-1].collect())
    *_, none = _pipeline(spark, docs.limit(0), sf)
    assert none.count() == 0


def test_pipeline_rejects_unlearnt_scripts(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = ["Это обычный русский текст о погоде и людях. " * 5, "これは日本語の文章です。今日は天気がいい。" * 5, "Αυτό είναι ένα ελληνικό κείμενο για τον καιρό. " * 5]
    strange = spark.createDataFrame([(10**12 + i, t, None, "s", 9) for i, t in enumerate(texts)], docs.schema)
    kept = corpus_pipeline.language(spark, docs.unionByName(strange), sf)
    assert kept.where("doc_id >= 1000000000000").count() == 0
    lettered = docs.where("text rlike '\\\\p{L}'")
    assert kept.count() >= 0.99 * lettered.count()


def test_pipeline_keeps_one_row_of_each_group(spark):
    import corpus_pipeline

    base = [f"w{i}" for i in range(60)]
    text, near = " ".join(base), " ".join(base[:-1] + ["end"])
    schema = "doc_id long, text string, lang string, source string, n_chars long"

    def kept(*rows):
        docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], schema).repartition(3)
        return sorted((str(r.doc_id), r.text) for r in corpus_pipeline.near_duplicate_groups(spark, docs, "").collect())

    assert kept((None, text), (None, text), (4, text)) == [("4", text)]
    assert kept((None, text), (4, near)) == [("4", near)]
    assert len(kept((None, text), (None, near))) == 1
    assert kept((2, text), (2, text), (9, text)) == [("2", text)]
    assert kept((3, "A"), (5, "A"), (5, "B")) == [("3", "A"), ("5", "B")]
    assert len(kept((None, None), (None, None), (6, ""))) == 3


def test_pipeline_without_anything_to_learn(spark, tmp_path):
    import corpus_pipeline

    docs = spark.createDataFrame([(i, f"Some plain words, number {i}.", None, "s", 9) for i in range(12)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for name, labels in (("empty", []), ("null", [(1, None, 0)]), ("both", [(1, 0, 0), (1, 1, 0)])):
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        assert corpus_pipeline.quality(spark, docs, f"{tmp_path}/{name}").exceptAll(docs).count() == 0
        assert corpus_pipeline.quality(spark, docs, f"{tmp_path}/{name}").count() == 12
    assert corpus_pipeline.language(spark, docs, str(tmp_path)).count() == 12


def test_registered_once_each():
    names = [n for n in entry_points.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
