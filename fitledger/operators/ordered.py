"""Row numbers and neighbours within a group that stay balanced when one group is huge.

A plain ``row_number`` or ``lag`` sends each group to one task. Here a cheap
pass counts the rows per group first. Groups above ``rows_per_slot`` are cut
into consecutive slots of their ordering value, and slots that are still
crowded are cut again; the window runs per slot, and what crosses a slot's
edge comes from a small per-slot summary. With no such group the plan is the
plain window.

The counting pass reads the keys of ``df``, and the ordering columns as well when a group is large; where those are
costly to compute, pass a stored table. It runs when the function is called.

The ordering columns by which groups are cut must be numeric or timestamps, the
others come last and only break ties. Ordering is ascending. Null keys make a group.
Rows that share the first ordering value are cut by the second, and so on; only rows
that agree in all of them (or in what a double can tell apart) stay together.

:func:`numbered` numbers a whole table in the order of some columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from fitledger.session import MAX_BROADCAST_ROWS, saved_table

ROWS_PER_SLOT = 1_000_000
# A slot is cut again when it has this many times its share of rows.
CROWDED = 4
# Each cut divides a value range by two at least, so this many tell any doubles apart.
MAX_CUTS = 64


def with_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str,
                    rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """Number the rows of each group from 1."""
    number = F.row_number()
    cut, slots = _cut_hot_groups(df, keys, order, rows_per_slot)
    if not slots:
        return df.withColumn(out, number.over(_window(keys, order)).cast("bigint"))
    edges = (
        cut.filter(F.col(slots[0]).isNotNull())
        .groupBy(*keys, *slots).agg(F.count(F.lit(1)).alias("__rows"))
        .withColumn("__before", F.sum("__rows").over(
            _window(keys, slots).rowsBetween(Window.unboundedPreceding, -1)))
        .drop("__rows")
    )
    return (
        _matched(cut, edges, [*keys, *slots])
        .withColumn(out, number.over(_window([*keys, *slots], order)) + F.coalesce("__before", F.lit(0)))
        .drop("__before", *slots)
    )


def with_neighbour(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   columns: Sequence[str], out: str, offset: int = -1,
                   rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """Add a struct of ``columns`` of the previous (-1) or next (+1) row; null at the end."""
    if offset not in (-1, 1):
        raise ValueError("offset must be -1 or 1")
    step, edge = (F.lag, F.max_by) if offset < 0 else (F.lead, F.min_by)
    row = F.struct(*columns)

    def beside(window):
        # Column by column: a struct would be a second copy of its columns in the shuffle.
        return F.when(
            step(F.lit(True)).over(window),
            F.struct(*[step(c).over(window).alias(c) for c in columns]),
        )

    cut, slots = _cut_hot_groups(df, keys, order, rows_per_slot)
    if not slots:
        return df.withColumn(out, beside(_window(keys, order)))
    edges = (
        cut.filter(F.col(slots[0]).isNotNull())
        .groupBy(*keys, *slots).agg(edge(row, F.struct(*order)).alias("__edge"))
        .withColumn("__beyond", step("__edge").over(_window(keys, slots)))
        .drop("__edge")
    )
    inside = beside(_window([*keys, *slots], order))
    return (
        _matched(cut, edges, [*keys, *slots])
        .withColumn(out, F.coalesce(inside, F.col("__beyond")))
        .drop("__beyond", *slots)
    )


def _window(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def _matched(df: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A left join in which null keys match."""
    names = {key: f"__key_{i}" for i, key in enumerate(keys)}
    named = summary.withColumnsRenamed(names)
    same = [F.col(key).eqNullSafe(F.col(name)) for key, name in names.items()]
    hint = F.broadcast(named) if "__small" in summary.columns else named
    return df.join(hint, reduce(and_, same), "left").drop(*names.values())


def _cut_hot_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    rows_per_slot: int) -> tuple[DataFrame, list[str]]:
    """Add slot columns, set for the rows of large groups only; no columns if there are none."""
    slots: list[str] = []
    limit = rows_per_slot
    leads = [name for name in order if _can_cut(df, name)]
    if not leads:
        raise TypeError(f"{order[0]} must be numeric or a timestamp")
    while True:
        group = [*keys, *slots]
        counted = df.filter(F.col(slots[-1]).isNotNull()) if slots else df
        # The first column whose values differ inside the group cuts it.
        bounds, lead, low, high = [], F.lit(None), F.lit(None), F.lit(None)
        for i, name in enumerate(leads):
            place = _place(df, name)
            bounds += [F.min(place).alias(f"__lo{i}"), F.max(place).alias(f"__hi{i}"),
                       F.min(name).alias(f"__from{i}"), F.max(name).alias(f"__to{i}"),
                       F.count_if(F.col(name).isNull()).alias(f"__void{i}")]
        for i in reversed(range(len(leads))):
            some_null = (F.col(f"__void{i}") > 0) & (F.col(f"__void{i}") < F.col("__n"))
            differs = F.coalesce(F.col(f"__from{i}") != F.col(f"__to{i}"), F.lit(False)) | some_null
            # Values that a double can't tell apart can't be cut, nor may a later column cut them.
            parts = some_null | (F.col(f"__hi{i}") > F.col(f"__lo{i}"))
            lead = F.when(differs, F.when(parts, i)).otherwise(lead)
            low = F.when(differs, F.col(f"__lo{i}")).otherwise(low)
            high = F.when(differs, F.col(f"__hi{i}")).otherwise(high)
        # One count for each group tells whether any has to be cut; only then are the bounds looked up.
        most = counted.groupBy(*group).agg(F.count(F.lit(1)).alias("__n")).agg(F.max("__n")).first()[0]
        if (most or 0) <= limit or len(slots) >= MAX_CUTS:
            return df, slots
        hot = saved_table(
            counted.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"), *bounds)
            .filter(F.col("__n") > limit)
            .select(*group, "__n", lead.alias("__lead"), low.alias("__lo"), high.alias("__hi"))
            # Nulls sort first and so can be parted from the rest even where the rest is one value.
            .filter(F.col("__lead").isNotNull()), "hot-groups")
        n_hot = hot.count()
        if n_hot == 0:
            return df, slots
        # At most rows(df) / rows_per_slot groups are this large.
        if n_hot <= MAX_BROADCAST_ROWS:
            hot = hot.withColumn("__small", F.lit(True))
        # The lowest value gets the first slot and the highest the last: every cut divides.
        n_slots = F.ceil(F.col("__n") / F.lit(rows_per_slot))
        place = F.lit(None).cast("double")
        for i, name in enumerate(leads):
            place = F.when(F.col("__lead") == i, _place(df, name)).otherwise(place)
        along = F.when(F.col("__hi") > F.col("__lo"), (place - F.col("__lo")) / (F.col("__hi") - F.col("__lo"))).otherwise(
            F.when(place.isNotNull(), 0.0))
        # Null comes before the first slot.
        slot = F.when(along.isNull(), -1).otherwise(F.least(F.floor(along * n_slots), n_slots - 1))
        is_cut = F.col(slots[-1]).isNotNull() if slots else F.col("__n").isNotNull()
        name = f"__slot{len(slots)}"
        df = (
            _matched(df, hot, group)
            # A part that is small enough keeps one slot; what is cut further is told apart by it.
            .withColumn(name, F.when(is_cut, F.when(F.col("__n").isNotNull(), slot).otherwise(F.lit(0))))
            .drop("__n", "__lead", "__lo", "__hi", "__small")
        )
        slots.append(name)
        limit = CROWDED * rows_per_slot


def _can_cut(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.TimestampType, T.NumericType))


def numbered(df: DataFrame, order: Sequence[Column], out: str, label: str = "numbered") -> DataFrame:
    """Number all rows from 0 in the order of some columns that tell every row apart.

    The rows are sorted by range, each range numbers its own, and a table of one
    row per range carries the counts across: no task holds more than a range.
    """
    stored = saved_table(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("__at", F.monotonically_increasing_id())
        # The upper bits of the id are the range's number.
        .withColumn("__range", F.shiftright("__at", 33)), label)
    counts = stored.groupBy("__range").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__range", "__first", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__start"))
    return (
        stored.join(F.broadcast(starts), "__range")
        .withColumn(out, F.col("__at") - F.col("__first") + F.col("__start"))
        .drop("__at", "__range", "__first", "__start")
    )


def _place(df: DataFrame, name: str) -> Column:
    """The ordering value as a double; values it cannot tell apart share a slot."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(name).cast("double")
    if isinstance(dtype, T.NumericType):
        return F.col(name).cast("double")
    raise TypeError(f"{name} must be numeric or a timestamp, not {dtype.simpleString()}")
