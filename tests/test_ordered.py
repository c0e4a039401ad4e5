"""Skew-safe row numbers and neighbours against plain windows and plain Python."""

from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from fitledger.operators.ordered import _cut_hot_groups, numbered, with_neighbour, with_row_number

ROWS = st.lists(st.tuples(st.sampled_from([1, 1, 1, 2, 3]), st.integers(-50, 50)), min_size=1, max_size=60)
QUICK = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def groups(rows):
    found = defaultdict(list)
    for i, (key, at) in enumerate(rows):
        found[key].append((at, i))
    return {key: sorted(items) for key, items in found.items()}


def frame(spark, rows):
    data = [(key, at, i) for i, (key, at) in enumerate(rows)]
    return spark.createDataFrame(data, "key int, at bigint, id int")


@QUICK
@given(rows=ROWS)
def test_row_number(spark, rows):
    got = with_row_number(frame(spark, rows), ["key"], ["at", "id"], "n", rows_per_slot=4)
    expected = {i: n for items in groups(rows).values() for n, (_, i) in enumerate(items, 1)}
    assert {r["id"]: r["n"] for r in got.collect()} == expected


@QUICK
@given(rows=ROWS, offset=st.sampled_from([-1, 1]))
def test_neighbour(spark, rows, offset):
    got = with_neighbour(frame(spark, rows), ["key"], ["at", "id"], ["id", "at"], "next", offset, rows_per_slot=4)
    expected = {}
    for items in groups(rows).values():
        for place, (_, i) in enumerate(items):
            other = place + offset
            expected[i] = (items[other][1], items[other][0]) if 0 <= other < len(items) else None
    assert {r["id"]: None if r["next"] is None else tuple(r["next"]) for r in got.collect()} == expected


def test_values_that_are_null_are_not_skipped(spark):
    df = spark.createDataFrame([(1, i, None if i % 2 else i) for i in range(20)], "key int, at int, v int")
    got = with_neighbour(df, ["key"], ["at"], ["v"], "before", -1, rows_per_slot=3)
    for r in got.collect():
        assert r["before"] is None if r["at"] == 0 else r["before"]["v"] == (None if (r["at"] - 1) % 2 else r["at"] - 1)


def test_null_order_values_come_first(spark):
    df = spark.createDataFrame([(1, None, 0), (1, None, 1)] + [(1, i, i + 2) for i in range(30)], "key int, at int, id int")
    got = with_row_number(df, ["key"], ["at", "id"], "n", rows_per_slot=5)
    assert {r["id"]: r["n"] for r in got.collect()} == {i: i + 1 for i in range(32)}


def test_timestamps(spark):
    df = spark.range(100).select(
        F.lit(1).alias("key"), F.timestamp_micros(F.col("id") * 7_000_003).alias("at"), "id")
    got = with_row_number(df, ["key"], ["at"], "n", rows_per_slot=10)
    assert all(r["n"] == r["id"] + 1 for r in got.collect())


def test_a_burst_is_cut_again(spark):
    """Nearly all rows of the group fall into a thousandth of its time span."""
    spread = [i * 100_000 for i in range(20)]
    burst = [500_000 + i for i in range(400)]
    df = spark.createDataFrame([(1, at) for at in spread + burst], "key int, at bigint")
    got = with_row_number(df, ["key"], ["at"], "n", rows_per_slot=20)
    plan = got._jdf.queryExecution().toString()
    assert "__slot1" in plan
    expected = {at: n for n, at in enumerate(sorted(set(spread + burst)), 1)}
    rows = got.collect()
    assert sorted(r["n"] for r in rows) == list(range(1, 421))
    assert [r["at"] for r in sorted(rows, key=lambda r: r["n"])] == sorted(spread + burst)
    before = with_neighbour(df.distinct(), ["key"], ["at"], ["at"], "prev", -1, rows_per_slot=20)
    places = sorted(expected)
    for r in before.collect():
        n = expected[r["at"]]
        assert (r["prev"] and r["prev"]["at"]) == (places[n - 2] if n > 1 else None)


@pytest.mark.parametrize("values,dtype", [
    ([1 + i * 1e-12 for i in range(60)], "double"),
    ([-(2 ** 63) + i for i in range(30)] + [2 ** 63 - 1 - i for i in range(30)], "bigint"),
])
def test_narrow_and_wide_ranges(spark, values, dtype):
    df = spark.createDataFrame([(1, v) for v in values], f"key int, at {dtype}")
    got = with_row_number(df, ["key"], ["at"], "n", rows_per_slot=5)
    assert [r["at"] for r in sorted(got.collect(), key=lambda r: r["n"])] == sorted(values)


def test_text_order_is_refused(spark):
    with pytest.raises(TypeError):
        with_row_number(spark.createDataFrame([(1, "a")], "key int, at string"), ["key"], ["at"], "n")


def test_ties_are_not_cut_for_ever(spark):
    df = spark.range(200).select(F.lit(1).alias("key"), F.lit(5).alias("at"), "id")
    got = with_row_number(df, ["key"], ["at", "id"], "n", rows_per_slot=10)
    assert all(r["n"] == r["id"] + 1 for r in got.collect())


def test_hot_group_is_cut_and_shuffled_by_slot(spark):
    df = spark.range(1000).select(F.lit(1).alias("key"), F.col("id").alias("at"))
    plan = with_row_number(df, ["key"], ["at"], "n", rows_per_slot=100)._jdf.queryExecution().toString()
    assert "__slot" in plan
    with pytest.raises(ValueError):
        with_neighbour(df, ["key"], ["at"], ["at"], "x", 2)


def test_small_groups_use_the_plain_window(spark):
    df = spark.range(1000).select((F.col("id") % 100).alias("key"), F.col("id").alias("at"))
    plan = with_row_number(df, ["key"], ["at"], "n")._jdf.queryExecution().toString()
    assert "__slot" not in plan and "Join" not in plan


def test_ties_and_null_keys_are_cut(spark):
    rows = [(None, 5, i) for i in range(300)] + [(1, 7, i) for i in range(300)] + [(1, None, i) for i in range(300, 500)]
    df = spark.createDataFrame(rows, "key int, at bigint, id int")
    got = with_row_number(df, ["key"], ["at", "id"], "n", rows_per_slot=20)
    numbers = {(r["key"], r["id"]): r["n"] for r in got.collect()}
    assert numbers == {**{(None, i): i + 1 for i in range(300)}, **{(1, i): i - 299 for i in range(300, 500)},
                       **{(1, i): i + 201 for i in range(300)}}
    cut, slots = _cut_hot_groups(df, ["key"], ["at", "id"], 20)
    assert cut.groupBy("key", *slots).count().agg(F.max("count")).first()[0] <= 80
    before = with_neighbour(df, ["key"], ["at", "id"], ["id"], "before", -1, rows_per_slot=20)
    found = {(r["key"], r["id"]): r["before"] and r["before"]["id"] for r in before.collect()}
    assert found[None, 0] is None and found[None, 200] == 199 and found[1, 0] == 499 and found[1, 300] is None


def test_numbered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    got = numbered(df, [F.desc("x")], "at")
    assert {r["x"]: r["at"] for r in got.collect()} == {x: 999 - x for x in range(1000)}
    assert numbered(df.limit(0), [F.desc("x")], "at").isEmpty()
