"""Near-duplicates: one-permutation MinHash with optimal densification, bands, star-shaped edges, exact links.

Rows with equal sets are one class. MinHash bands put classes into buckets, and in each bucket a star of candidate edges goes from its
least class to the others: as many edges as members, however many pairs they make. The components of
these edges, the *clusters*, hold every pair that shares a bucket. The full sets of a cluster come together
once, in blocks of bounded size, and are compared by counting their common shingles in one matrix product.
A cluster of one block is done then. In a larger one each block also holds the cluster's hubs, the classes with
most candidate edges; what is still outside its largest component afterwards meets the other
blocks, pair of blocks by pair of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window, functions as F

from fitledger.llm.words import chained, is_space, mix, slices, words
from fitledger.session import broadcast_if_small, saved_table

# Documents are linked by shingles of so many words, of which this share is common.
SHINGLE, PERCENT = 5, 80
# A pair of similarity 0.8 shares no band with a chance of 4e-7.
BANDS, ROWS = 28, 4
# A block of a cluster has about so many classes and shingles; a cluster of several has so many hubs.
BLOCK, BLOCK_SHINGLES, HUBS = 256, 1 << 19, 4
# Classes whose places go to every executor: some 60 bytes each.
MAX_KEYS = 1_000_000
# Links of which a task makes stars at once.
LINKS = 1 << 20
# A file of an intermediate table has at least so many values, unless the cores want more files.
FILE_VALUES = 1 << 20
# Shingles that go into the matrix product at once.
COLUMNS = 1 << 12


# ---- sketches, in numpy

def shingle_sets(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and the offsets of the texts.

    Words are runs of anything but white space, A-Z lower-cased. A text of fewer words than a shingle has
    its whole sequence as its only one; a text without words has none.
    """
    _, _, _, hashes, firsts = words(column, is_space_free())
    n_words = np.diff(firsts)
    owner = np.repeat(np.arange(len(n_words)), n_words)
    parts, owners = [], []
    grams = chained(hashes, size)
    whole = owner[:len(grams)] == owner[size - 1:] if len(grams) else np.zeros(0, bool)
    parts.append(grams[whole])
    owners.append(owner[:len(grams)][whole])
    for n in range(1, size):
        short = np.flatnonzero(n_words == n)
        if len(short):
            parts.append(mix(chained(hashes, n)[firsts[short]] + np.uint64(n)))
            owners.append(short)
    values, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(n_words) + 1))


def is_space_free() -> np.ndarray:
    return ~is_space()


def signatures(values: np.ndarray, offsets: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation MinHash of each set: the least hash in each bin, empty bins filled by densification.

    Optimal densification: an empty bin takes the value of the first full bin in a random sequence of
    bins that depends on the empty bin only, so equal sets of full bins fill it alike.
    """
    n = len(offsets) - 1
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    table = np.full((n, bins), empty, np.uint64)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    scrambled = mix(values ^ np.uint64(0x5851F42D4C957F2D))
    slot = ((scrambled >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    key = owner * bins + slot
    order = np.lexsort((scrambled, key))
    key, least = key[order], scrambled[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    table.reshape(-1)[key[first]] = least[first]
    rows, cols = np.nonzero((table == empty) & (np.diff(offsets) > 0)[:, None])
    full = table != empty
    attempt = 0
    while len(rows):
        attempt += 1
        probe = (mix(cols.astype(np.uint64) * np.uint64(1_000_003) + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        hit = full[rows, probe]
        table[rows[hit], cols[hit]] = table[rows[hit], probe[hit]]
        rows, cols = rows[~hit], cols[~hit]
    return table


def band_keys(table: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.tile(np.arange(bands, dtype=np.uint64), (len(table), 1))
    for k in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + table[:, k::rows])
    return keys.astype(np.int64)


SKETCH = "id long, n long, key1 long, key2 long, bands array<long>"
SETS = "key1 long, key2 long, shingles array<long>"


def _digest(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that identify a set."""
    sums = []
    for salt in (1, 2):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values + np.uint64(salt)))])
        sums.append((total[offsets[1:]] - total[offsets[:-1]]).astype(np.int64))
    return sums[0], sums[1]


def _lists(lengths: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(values))


def _sketched(shingle: int, bands: int, rows: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                values, offsets = shingle_sets(part.column("text"), shingle)
                key1, key2 = _digest(values, offsets)
                n = np.diff(offsets)
                keys = band_keys(signatures(values, offsets, bands * rows), bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n), pa.array(key1), pa.array(key2),
                     _lists(np.where(n > 0, bands, 0), keys[n > 0].reshape(-1))], ["id", "n", "key1", "key2", "bands"])

    return sketch


def _with_sets(shingle: int):
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task gives each set once, however many rows have it.
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                values, offsets = shingle_sets(part.column("text"), shingle)
                key1, key2 = _digest(values, offsets)
                new = [i for i, key in enumerate(zip(key1.tolist(), key2.tolist())) if not (key in seen or seen.add(key))]
                lists = _lists(np.diff(offsets), values.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key1[new]), pa.array(key2[new]), lists.take(pa.array(new, pa.int64()))], ["key1", "key2", "shingles"])

    return collect


# ---- blocks of sets

def common_counts(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """How many values each set shares with each other one (with itself only those it shares with others, too):
    sums of matrix products over parts of the values."""
    sets = left + (right or [])
    sizes = [len(s) for s in sets]
    owner, values = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    owner, values = owner[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    firsts = np.flatnonzero(new)
    # A value of one set only is shared by none.
    shared = np.diff(np.append(firsts, len(values))) > 1
    column = np.cumsum(new) - 1
    member = shared[column]
    owner, column = owner[member], (np.cumsum(shared) - 1)[column[member]]
    n, found = len(left), np.zeros((len(left), len(right) if right else len(left)), np.int64)
    for low in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        table = np.zeros((len(sets), COLUMNS), np.float32)
        table[owner[a:b], column[a:b] - low] = 1
        found += (table[:n] @ table[n if right else 0:].T).astype(np.int64)
    return found


def alike(sizes_a: np.ndarray, sizes_b: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets are alike: 100 * common >= percent * all."""
    return common * 100 >= (sizes_a[:, None] + sizes_b[None, :] - common) * percent


def local_roots(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric table of links the least row that it reaches."""
    roots = np.arange(len(linked))
    linked = linked | np.eye(len(linked), dtype=bool)
    while True:
        least = np.where(linked, roots[None, :], len(roots)).min(axis=1)
        least = least[least]
        if (least == roots).all():
            return roots
        roots = least


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, from batches sorted by the keys; only one group is held."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(k).to_numpy() for k in keys], axis=1)
        cuts = np.concatenate([[0], np.flatnonzero((rows[1:] != rows[:-1]).any(axis=1)) + 1, [len(rows)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            if last is not None and (rows[a] != last).any():
                yield pa.Table.from_batches(held)
                held = []
            last = rows[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _rows(group: pa.Table) -> tuple[pa.Table, list[np.ndarray]]:
    """A group's rows, each class once, in the order of their ids, and their sets."""
    ids = group.column("id").to_numpy()
    _, firsts = np.unique(ids, return_index=True)
    group = group.take(pa.array(firsts)).combine_chunks()
    lists = group.column("shingles").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    return group, [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _compared(percent: int):
    """(id, component) within a block."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["cluster", "block"]):
            group, sets = _rows(group)
            sizes = np.array([len(s) for s in sets])
            roots = local_roots(alike(sizes, sizes, common_counts(sets), percent))
            ids = group.column("id").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[roots])], ["id", "component"])

    return compare


def _crossed(percent: int):
    """(a, b): components that a link joins, between the outside rows of a pair of blocks and its others."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["cluster", "block", "facing"]):
            sides = []
            for outside in (True, False):
                part, sets = _rows(group.filter(pa.compute.equal(group.column("outside"), outside)))
                sides.append((part.column("component").to_numpy(), sets, np.array([len(s) for s in sets], np.int64)))
            (names_a, sets_a, sizes_a), (names_b, sets_b, sizes_b) = sides
            if not sets_a or not sets_b:
                continue
            linked = alike(sizes_a, sizes_b, common_counts(sets_a, sets_b), percent)
            linked &= names_a[:, None] != names_b[None, :]
            i, j = np.nonzero(linked)
            pairs = np.unique(np.stack([names_a[i], names_b[j]], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return compare


# ---- components

def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node that it reaches) for each node of the links that is not itself the least."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[:len(a)], ends[len(a):]
    roots = np.arange(len(nodes))
    while True:
        over, under = np.maximum(roots[left], roots[right]), np.minimum(roots[left], roots[right])
        apart = over != under
        if not apart.any():
            inner = roots != np.arange(len(nodes))
            return nodes[inner], nodes[roots[inner]]
        np.minimum.at(roots, over[apart], under[apart])
        while True:
            further = roots[roots]
            if (further == roots).all():
                break
            roots = further


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars with the same components as a task's links (u, v), taken LINKS at a time."""
    held, n = [], 0
    for batch in batches:
        held.append([c.to_numpy() for c in batch.columns])
        n += batch.num_rows
        if n >= LINKS:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in forest(*map(np.concatenate, zip(*held)))], ["u", "v"])
            held, n = [], 0
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in forest(*map(np.concatenate, zip(*held)))], ["u", "v"])


def _few_files(rows: DataFrame, values: int) -> DataFrame:
    """A table of ``values`` numbers at most in as many partitions as it needs, where a shuffle has made more."""
    return rows.coalesce(max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-values // FILE_VALUES)))


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(id, component): the least id that is reachable, for all ids in links (a, b) with another one.

    Small-star steps with a jump: a node and its smaller neighbours move to the least of them, and further to that
    one's least neighbour. Before each step every task makes stars of the links that it has at hand, so a node's smaller
    neighbours are as many as the tasks at most. A round is one shuffle: each node's neighbourhood is written to the
    shared folder, and the next round starts from there. The driver learns only whether all nodes are in stars.
    """
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    n_links = links.count()
    while True:
        stars = edges.mapInArrow(_forests, "u long, v long")
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smaller = F.when(F.col("v") < F.col("u"), F.col("v"))
        nodes = both.groupBy("u").agg(F.collect_set(smaller).alias("below"), F.max(F.col("v") > F.col("u")).alias("above"))
        nodes = saved_table(_few_files(nodes, 4 * n_links), label)
        # In a star each node but the centre has one neighbour, which is smaller.
        if nodes.where("size(below) > 1 or (size(below) > 0 and above)").isEmpty():
            return nodes.select(F.col("u").alias("id"), F.coalesce(F.array_min("below"), "u").alias("component"))
        # A node and its smaller neighbours join the least of them, or the least neighbour which that one has itself.
        ends = nodes.where("size(below) > 0").select("u", "below", F.array_min("below").alias("least"))
        inner = nodes.where("size(below) > 0 and above").select(F.col("u").alias("least"), F.array_min("below").alias("further"))
        edges = ends.join(broadcast_if_small(inner), "least", "left").select(
            F.explode(F.array_append("below", F.col("u"))).alias("u"), F.coalesce("further", "least").alias("v")).where("u <> v")


def near_duplicates(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT, bands: int = BANDS, band_rows: int = ROWS) -> DataFrame:
    """One row (id, n_shingles, component_id, kept) for each document.

    The method is the module's. Every row has a written number of its own, and a class is known by its least.
    No link between classes of a common bucket is lost.

    ``shingle`` words make a shingle, and texts are linked from ``percent`` of their shingles in common on. A pair of
    exactly that similarity s shares no band with a chance of (1 - s ** band_rows) ** bands; a lower ``percent``
    asks for fewer ``band_rows``.

    ``component_id`` is the least id of the component, and rows with that id are kept. A null id is linked like
    any other and comes last: a component of null ids only has a null ``component_id`` and keeps one row. Rows
    that repeat an id are linked by their own texts. A text without words (or null) has an empty set, is alone
    and kept. An empty table gives no rows; other columns are ignored.
    """
    texts = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    rows = saved_table(texts.mapInArrow(_sketched(shingle, bands, band_rows), SKETCH)
                       .withColumn("row", F.monotonically_increasing_id()), "near-sketches")
    # From here to the components, an id is the number of a class's first row; ``doc`` is the id of that row.
    classes = (
        rows.where("n > 0").groupBy("key1", "key2").agg(
            F.min(F.struct("row", F.col("id").alias("doc"))).alias("first"), F.min("id").alias("least"),
            F.first("n").alias("n"), F.first("bands").alias("bands"))
        .select(F.col("first.row").alias("id"), F.col("first.doc").alias("doc"), "least", "n", "key1", "key2", "bands"))
    classes = saved_table(_few_files(classes, rows.count() * bands), "near-classes")
    n_banded = classes.count() * bands

    banded = classes.select(F.explode("bands").alias("bucket"), "id")
    centres = (banded.groupBy("bucket").agg(F.min("id").alias("a"), F.max("id").alias("b"))
               .where("a < b").select("bucket", "a"))
    stars = (
        banded.join(broadcast_if_small(saved_table(_few_files(centres, n_banded), "near-centres")), "bucket").where("id <> a")
        .select("a", F.col("id").alias("b")).distinct())
    stars = saved_table(_few_files(stars, 2 * n_banded), "near-stars")
    clustered = components(stars).withColumnRenamed("component", "cluster")
    keys = saved_table(classes.drop("bands", "least").join(broadcast_if_small(clustered), "id"), "near-keys")
    joined = _linked(texts, keys, stars, shingle, percent)

    # The least id of each component of several classes; a class alone has its own.
    joined = broadcast_if_small(joined.withColumnRenamed("id", "class"))
    linked = classes.select(F.col("id").alias("class"), "least").join(joined, "class")
    labels = linked.groupBy("component").agg(F.min("least").alias("first_id"), F.count(F.lit(1)).alias("size")).where("size > 1")
    labels = saved_table(_few_files(labels, n_banded), "near-labels")
    linked = linked.select("class", "component").join(broadcast_if_small(labels), "component")
    by_class = classes.join(broadcast_if_small(linked), F.col("id") == F.col("class"), "left").select(
        "key1", "key2", F.coalesce("component", "id").alias("first_row"),
        F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("first_id")).alias("found"))
    out = rows.select("id", "row", "n", "key1", "key2").join(by_class, ["key1", "key2"], "left")
    component = F.when(F.col("n") > 0, F.col("found")).otherwise(F.col("id"))
    kept = F.when((F.col("n") > 0) & F.col("found").isNull(), F.col("row") == F.col("first_row")).otherwise(
        F.col("id").eqNullSafe(component))
    return out.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      kept.alias("kept"))


def _linked(texts: DataFrame, keys: DataFrame, stars: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(id, component) of the classes in clusters, by exact links."""
    sizes = keys.groupBy("cluster").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("shingles"))
    n_keys = keys.count()
    large = (
        sizes.withColumn("blocks", F.greatest(F.ceil(F.col("classes") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)))
        .where("blocks > 1").select("cluster", "blocks"))
    large = saved_table(_few_files(large, 2 * n_keys), "near-large")
    n_large = large.count()
    placed = keys.select("id", "doc", "key1", "key2", "cluster")
    if n_large:
        held = broadcast_if_small(large)
        edges = stars.select("a").unionByName(stars.select(F.col("b").alias("a"))).groupBy(F.col("a").alias("id")).agg(
            F.count(F.lit(1)).alias("edges"))
        first = Window.partitionBy("cluster").orderBy(F.desc("edges"), "id")
        hubs = (keys.select("id", "cluster").join(held, "cluster").join(edges, "id")
                .withColumn("place", F.row_number().over(first)).where(F.col("place") <= HUBS)
                .select("id", F.lit(True).alias("hub")))
        hubs = saved_table(_few_files(hubs, HUBS * n_large), "near-hubs")
        placed = placed.join(held, "cluster", "left").join(broadcast_if_small(hubs), "id", "left")
        own = F.array(F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("id"), F.col("blocks"))))
        spread = F.when(F.col("hub"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(own)
    else:
        spread = F.array(F.lit(0).cast("long"))
    placed = saved_table(placed.withColumn("spread", spread).select("id", "doc", "key1", "key2", "cluster", "spread"), "near-placed")
    named = placed.where("doc is not null").select(F.col("doc").alias("id")).distinct()
    # Null ids can't be looked up: their texts go through once more.
    again = texts.where("id is not null").join(broadcast_if_small(named), "id", "left_semi")
    if not placed.where("doc is null").isEmpty():
        again = again.unionByName(texts.where("id is null"))
    sets = again.mapInArrow(_with_sets(shingle), SETS).join(
        broadcast_if_small(placed.drop("doc"), MAX_KEYS), ["key1", "key2"]).drop("key1", "key2")
    if n_large:
        sets = saved_table(sets, "near-sets")
    dealt = sets.select("id", "cluster", "shingles", F.explode("spread").alias("block"))
    joined = saved_table(_dealt(dealt, "cluster", "block").mapInArrow(_compared(percent), "id long, component long"), "near-links")
    if not n_large:
        return joined
    # Classes in several blocks (hubs) tie the blocks of a cluster together.
    joined = components(joined.toDF("a", "b"))
    return _across(keys, sets, joined, large, percent)


def _dealt(rows: DataFrame, *by: str) -> DataFrame:
    return rows.repartition(*by).sortWithinPartitions(*by)


def _across(keys: DataFrame, sets: DataFrame, joined: DataFrame, large: DataFrame, percent: int) -> DataFrame:
    """Components after the classes outside the largest of a large cluster have met its other blocks."""
    named = saved_table(keys.select("id", "cluster", "n").join(broadcast_if_small(joined), "id", "left")
                        .withColumn("component", F.coalesce("component", "id")), "near-named")
    members = named.join(broadcast_if_small(large), "cluster")
    parts = members.groupBy("cluster", "component").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"))
    # The largest component of each cluster, ties to the least.
    totals = parts.groupBy("cluster").agg(
        F.max(F.struct("size", (-F.col("component")).alias("down"), "shingles")).alias("top"),
        F.sum("size").alias("classes"), F.sum("shingles").alias("all"))
    rest = (
        totals.select("cluster", "classes", "all", (-F.col("top.down")).alias("largest"), "top.size", F.col("top.shingles").alias("inside"))
        .join(broadcast_if_small(large), "cluster")
        .withColumn("facings", F.greatest(F.ceil((F.col("classes") - F.col("size")) / BLOCK),
                                          F.ceil((F.col("all") - F.col("inside")) / BLOCK_SHINGLES)))
        .where("classes > size").select("cluster", "largest", "blocks", "facings")
    )
    rest = saved_table(_few_files(rest, 4 * large.count()), "near-rest")
    if rest.isEmpty():
        return named.select("id", "component")
    open_sets = saved_table(
        members.select("id", "cluster", "component").join(broadcast_if_small(rest), "cluster")
        .withColumn("outside", F.col("component") != F.col("largest")), "near-open")
    full = sets.select("id", "shingles").join(broadcast_if_small(open_sets), "id")

    def whole(count):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    h = F.xxhash64("id")
    outside = full.where("outside").withColumn("facing", F.pmod(h, F.col("facings"))).withColumn("block", whole("blocks"))
    others = full.withColumn("outside", F.lit(False)).withColumn("block", F.pmod(h, F.col("blocks"))).withColumn(
        "facing", whole("facings"))
    columns = ["cluster", "block", "facing", "outside", "id", "component", "shingles"]
    met = outside.select(*columns).unionByName(others.select(*columns))
    more = saved_table(_dealt(met, "cluster", "block", "facing").mapInArrow(_crossed(percent), "a long, b long"), "near-crossed")
    # Links between components join these whole.
    merged = components(more).select(F.col("id").alias("component"), F.col("component").alias("into"))
    return saved_table(named.select("id", "component").join(broadcast_if_small(merged), "component", "left")
                       .select("id", F.coalesce("into", "component").alias("component")), "near-joined")
