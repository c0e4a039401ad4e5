"""Mixing overlapping sources to target weights: min-cost flow over membership patterns, seeded selection."""

from __future__ import annotations

import math
from collections import defaultdict, deque

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from fitledger.operators.ordered import numbered, with_row_number
from fitledger.session import broadcast_if_small, saved_table

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
# Overlapping membership patterns are planned on the driver; more of these than this are an error.
MAX_PATTERNS = 200_000
# Seeded hashes are cut into so many bins per pattern, so that no window holds a whole source.
BINS = 4096
HASH_BITS = 60
WORD_GAP = "[\\x20\\x09-\\x0D]+"


def word_count(text):
    """Number of runs of characters that aren't white space (0x20, 0x09 to 0x0D); 0 for null."""
    parts = F.split(text, WORD_GAP)
    empty = lambda i: (F.element_at(parts, i) == "").cast("int")
    # Only the first and the last part can be empty; an empty text has one part that is both.
    n = F.size(parts) - empty(1) - F.when(F.size(parts) > 1, empty(-1)).otherwise(0)
    return F.when(text.isNull(), 0).otherwise(n).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: float = MAX_REPEATS, total: float | None = None) -> DataFrame:
    """(source, size, target): words wanted of each source (source, size), shares of the total by weight.

    Sources in code point order (null last) take the weights in turn. No target is above ``max_repeats`` times its
    source's size; what a full source can't take is shared among the others by weight, until none is above
    its limit. Each round is one aggregate, of which three numbers reach the driver.
    """
    # A null sorts last by a column of its own; in bytes of UTF-8 the order is that of code points.
    named = numbered(sizes.withColumn("void", F.col("source").isNull()), [F.col("void"), F.col("source")], "place", "mix-sources")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    named = saved_table(named.select("source", "size", turn.alias("weight")), "mix-weights")
    if total is None:
        total = named.agg(F.sum("size")).first()[0] or 0
    most, full = F.col("size") * F.lit(float(max_repeats)), F.lit(False)
    while True:
        fixed, share, n_full = named.agg(
            F.sum(F.when(full, most)), F.sum(F.when(~full, F.col("weight"))), F.count_if(full)).first()
        want = F.lit(float(total) - (fixed or 0.0)) * F.col("weight") / F.lit(float(share or 1))
        above = full | (want > most)
        if named.agg(F.count_if(above)).first()[0] == n_full:
            return named.select("source", "size", F.when(full, most).otherwise(want).alias("target"))
        full = above


def min_cost_flow(patterns: list[tuple[frozenset, int]], quotas: dict, max_repeats: int = MAX_REPEATS) -> list[int]:
    """Tokens that each pattern (member sources, size) gives, so that the quotas are filled at least cost.

    A pattern gives its size once at cost 0, again at cost 1, and so on up to ``max_repeats`` times: a
    convex cost, so that repeats are spread over all patterns that can serve a source. Paths of least cost
    are augmented one after the other, within one connected part of patterns and sources at a time.
    """
    parent = {("s", s): ("s", s) for s in quotas}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for sources, _ in patterns:
        first, *others = [root(("s", s)) for s in sources] or [None]
        for other in others:
            parent[root(other)] = root(first)
    parts = defaultdict(list)
    for i, (sources, size) in enumerate(patterns):
        if sources and size > 0:
            parts[root(("s", next(iter(sources))))].append(i)
    given = [0] * len(patterns)
    for members in parts.values():
        for i, tokens in _flow_in_part([patterns[i] for i in members], quotas, max_repeats).items():
            given[members[i]] = tokens
    return given


def _flow_in_part(patterns, quotas, max_repeats) -> dict[int, int]:
    sources = sorted({s for members, _ in patterns for s in members}, key=lambda s: (s is None, s or ""))
    left = {s: quotas[s] for s in sources}
    serves = defaultdict(list)
    for i, (members, _) in enumerate(patterns):
        for s in members:
            serves[s].append(i)
    flow: dict = defaultdict(int)       # (pattern, source) to tokens
    given = [0] * len(patterns)
    for level in range(max_repeats):    # all tokens of one cost before any of the next
        spare = [(level + 1) * size - given[i] for i, (_, size) in enumerate(patterns)]
        while True:
            # Breadth first from patterns with spare tokens, over sources, back over patterns that serve them.
            before: dict = {("p", i): None for i, n in enumerate(spare) if n > 0}
            queue, end = deque(before), None
            while queue and end is None:
                kind, x = node = queue.popleft()
                if kind == "p":
                    steps = [("s", s) for s in patterns[x][0]]
                else:
                    steps = [("p", i) for i in serves[x] if flow[i, x] > 0]
                for step in steps:
                    if step not in before:
                        before[step] = node
                        if step[0] == "s" and left[step[1]] > 0:
                            end = step
                            break
                        queue.append(step)
            if end is None:
                break
            path = [end]
            while before[path[-1]] is not None:
                path.append(before[path[-1]])
            path.reverse()
            amount = min(spare[path[0][1]], left[end[1]])
            for a, b in zip(path, path[1:]):
                if a[0] == "s":
                    amount = min(amount, flow[b[1], a[1]])
            for a, b in zip(path, path[1:]):
                if a[0] == "p":
                    flow[a[1], b[1]] += amount
                else:
                    flow[b[1], a[1]] -= amount
            spare[path[0][1]] -= amount
            given[path[0][1]] += amount
            left[end[1]] -= amount
    return dict(enumerate(given))


def seeded_hash(id_, seed: int):
    """60 bits of the MD5 of seed and id: the same order in every run and engine."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def mix(documents: DataFrame, id_column: str = "doc_id", sources_column: str = "source", text_column: str = "text",
        weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = 0) -> DataFrame:
    """One row (id, size, source_size, target, taken) per document; ``taken`` counts words, repeats included.

    ``sources_column`` is one source or an array of them (a document of several overlapping sources; null
    or an empty array is the source null). Documents are summed by membership pattern; a min-cost
    flow routes the patterns' tokens to the sources' targets. Within a pattern each document is taken as
    often as the flow's whole rounds say, and what is left goes to documents in seeded order, the last one in part,
    so that the words taken of a pattern are those routed, exactly. ``source_size`` and ``target`` are sums
    over a document's sources. The order's ties are broken by size; rows equal in id and size are interchangeable,
    so reruns agree. Empty or null texts have size 0 and are taken 0 times; an empty table gives no rows.
    """
    many = isinstance(documents.schema[sources_column].dataType, T.ArrayType)
    member = F.col(sources_column) if many else F.array(F.col(sources_column))
    pattern = F.sort_array(F.array_distinct(F.when(F.size(member) > 0, member).otherwise(
        F.array(F.lit(None).cast("string")))))
    rows = documents.select(
        F.col(id_column).alias(id_column), F.transform(pattern, lambda s: s.cast("string")).alias("pattern"),
        word_count(F.col(text_column)).alias("size"), seeded_hash(F.col(id_column), seed).alias("order"))
    # The texts are read once; what follows is narrow.
    rows = saved_table(rows.withColumn("bin", F.shiftright("order", HASH_BITS - 12).cast("int"))
                       .withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    patterns = saved_table(rows.groupBy("pattern").agg(F.sum("size").alias("size")), "mix-patterns")
    plan = broadcast_if_small(saved_table(_planned(patterns, weights, max_repeats), "mix-plan"))
    # Words before each bin in seeded order: one row for each pattern and bin that has documents.
    earlier = Window.partitionBy("pattern").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = (rows.groupBy("pattern", "bin").agg(F.sum("size").alias("bin_size"))
            .withColumn("before", F.coalesce(F.sum("bin_size").over(earlier), F.lit(0))))
    # Only the bin in which the rest of a pattern ends needs its documents in order.
    cut = bins.join(plan.select("pattern", "rest"), "pattern").where(
        (F.col("before") < F.col("rest")) & (F.col("before") + F.col("bin_size") >= F.col("rest"))
    ).select("pattern", F.col("bin").alias("cut_bin"), "before")
    cut = broadcast_if_small(saved_table(cut, "mix-cut"))
    planned = rows.join(plan, "pattern").join(cut, "pattern", "left")
    at = F.struct("order", F.col(id_column).cast("string").alias("id"), "size")
    # Equal rows are one row here, so neither a repeated id nor a repeated document crowds a bin.
    alike = rows.join(cut, "pattern").where("bin = cut_bin").groupBy("pattern", "before", at.alias("at")).agg(
        F.count(F.lit(1)).alias("rows"))
    ahead = Window.partitionBy("pattern").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ends = alike.withColumn("left", F.lit(0) - F.col("before") - F.coalesce(
        F.sum(F.col("rows") * F.col("at.size")).over(ahead), F.lit(0)))
    ends = ends.join(plan.select("pattern", "rest"), "pattern").withColumn("left", F.col("left") + F.col("rest"))
    # The place where the rest ends: so many of its equal rows are taken whole and the next one in part.
    end = ends.where((F.col("left") > 0) & (F.col("left") <= F.col("rows") * F.col("at.size"))).select(
        "pattern", F.col("at").alias("end"), F.expr("left div at.size").alias("full"), (F.col("left") % F.col("at.size")).alias("part"))
    end = broadcast_if_small(saved_table(end, "mix-end"))
    once = F.when(F.col("end").isNull(), F.when(F.col("bin") < F.col("cut_bin"), F.col("size")).otherwise(0)).when(
        (F.col("bin") < F.col("cut_bin")) | ((F.col("bin") == F.col("cut_bin")) & (at < F.col("end"))), F.col("size")).otherwise(0)
    placed = planned.join(end, "pattern", "left").withColumn("once", F.coalesce(once, F.lit(0)))
    on_end = (F.col("bin") == F.col("cut_bin")) & at.eqNullSafe(F.col("end"))
    on_end = F.coalesce(on_end, F.lit(False))
    columns = [id_column, "size", "source_size", "target", (F.col("rounds") * F.col("size") + F.col("once")).alias("taken")]
    last = with_row_number(
        placed.where(on_end).withColumn("group", F.xxhash64("pattern")), ["group"], ["row"], "nth").withColumn(
        "once", F.when(F.col("nth") <= F.col("full"), F.col("size")).when(F.col("nth") == F.col("full") + 1, F.col("part")).otherwise(0))
    return placed.where(~on_end).select(*columns).unionByName(last.select(*columns))


def _planned(patterns: DataFrame, weights, max_repeats: int) -> DataFrame:
    """(pattern, source_size, target, rounds, rest): whole rounds that a pattern gives, and the words beyond them.

    A pattern of one source that no other pattern shares gives its source's rounded target. Only patterns that overlap, and
    those connected with them by a source, go through the flow on the driver.
    """
    members = patterns.select("pattern", "size", F.explode("pattern").alias("source"))
    sizes = members.groupBy("source").agg(F.sum("size").alias("size"))
    total = patterns.agg(F.sum("size")).first()[0] or 0
    wanted = saved_table(targets(sizes, weights, max_repeats, total), "mix-targets")
    many = members.where(F.size("pattern") > 1).select("source").distinct()
    many = saved_table(many, "mix-overlaps")
    alone = patterns.where(F.size("pattern") == 1).withColumn("source", F.element_at("pattern", 1))
    other = broadcast_if_small(many.withColumnRenamed("source", "other"))
    same = F.col("source").eqNullSafe(F.col("other"))
    single = alone.join(other, same, "left_anti").join(
        broadcast_if_small(wanted.select(F.col("source").alias("named"), "target")), F.col("source").eqNullSafe(F.col("named")))
    tokens = F.least(F.floor(F.col("target") + 0.5), F.col("size") * max_repeats)
    plan = single.select("pattern", F.col("size").alias("source_size"), "target", "size", tokens.alias("tokens"))
    if not many.isEmpty():
        shared = patterns.where(F.size("pattern") > 1).unionByName(alone.join(other, same, "left_semi").drop("source"))
        plan = plan.unionByName(_routed(shared, wanted.join(other, same, "left_semi"), max_repeats))
    return plan.select(
        "pattern", "source_size", "target",
        F.when(F.col("size") > 0, F.expr("tokens div size")).otherwise(0).alias("rounds"),
        F.when(F.col("size") > 0, F.col("tokens") % F.col("size")).otherwise(0).alias("rest"))


def _routed(patterns: DataFrame, wanted: DataFrame, max_repeats: int) -> DataFrame:
    """(pattern, source_size, target, size, tokens) of overlapping patterns, by min-cost flow."""
    found = patterns.limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} overlapping membership patterns: group sources first")
    found = sorted(((frozenset(r["pattern"]), r["size"], list(r["pattern"])) for r in found),
                   key=lambda p: [(s is None, s or "") for s in p[2]])
    sources = {r["source"]: r for r in wanted.collect()}       # those of the patterns above
    given = min_cost_flow([p[:2] for p in found], {s: math.floor(r["target"] + 0.5) for s, r in sources.items()}, max_repeats)
    return patterns.sparkSession.createDataFrame(
        [(names, sum(sources[s]["size"] for s in members), float(sum(sources[s]["target"] for s in members)), size, tokens)
         for (members, size, names), tokens in zip(found, given)],
        "pattern array<string>, source_size long, target double, size long, tokens long")
