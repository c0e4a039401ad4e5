"""Properties of the batch layout, and its learning rate against plain Python."""

import math

import pytest
from pyspark.sql import functions as F

from fitledger.catalog import layout
from fitledger.functions import learning_rate, total_steps
from fitledger.plans import assign_rank, assign_step, epochs, example_index, lay_out, steps_per_epoch
from conftest import MEDIUM


def ids(spark, n):
    return spark.range(n).withColumnRenamed("id", "doc_id")


@pytest.mark.parametrize("n,world,batch,accum", [(1000, 4, 1, 8), (37, 3, 2, 2), (1, 4, 1, 8), (64, 2, 4, 8)])
def test_every_example_has_one_place(spark, n, world, batch, accum):
    plan = assign_step(assign_rank(example_index(ids(spark, n), "doc_id"), world, batch), world, batch, accum)
    rows = plan.collect()
    assert sorted(r["idx"] for r in rows) == list(range(n))
    for r in rows:
        assert r["rank"] == r["idx"] // batch % world
        assert r["opt_step"] == r["idx"] // batch // world // accum + 1
    loads = {rank: sum(r["rank"] == rank for r in rows) for rank in range(world)}
    assert max(loads.values()) - min(loads.values()) <= batch
    sizes = {}
    for r in rows:
        sizes[r["opt_step"]] = sizes.get(r["opt_step"], 0) + 1
    last = max(sizes)
    assert all(size == world * batch * accum for step, size in sizes.items() if step < last)
    assert steps_per_epoch(ids(spark, n), world, batch, accum).first()["steps"] == last


def test_known_step_count(spark):
    assert steps_per_epoch(ids(spark, 15_000), 4).first()["steps"] == 469


def test_seed_changes_the_order(spark):
    order = lambda seed: [r["doc_id"] for r in example_index(ids(spark, 50), "doc_id", seed).orderBy("idx").collect()]
    assert order(1) != order(2)
    assert order(1) == order(1)


@pytest.mark.parametrize("hex_digits", [1, 2, 5])
def test_order_does_not_depend_on_the_parts(spark, hex_digits):
    a = example_index(ids(spark, 300), "doc_id", hex_digits=hex_digits).select("doc_id", "idx")
    b = example_index(ids(spark, 300), "doc_id").select("doc_id", "idx")
    assert a.exceptAll(b).isEmpty()


@pytest.mark.parametrize("total", [1, 2, 33, 469])
def test_learning_rate(spark, total):
    base, warm = 2e-4, math.ceil(0.03 * total)
    rows = spark.range(total).select("id", learning_rate(F.col("id"), F.lit(total)).alias("lr")).collect()
    for step, lr in rows:
        expected = (base * step / max(warm, 1) if step < warm else
                    base * 0.5 * (1 + math.cos(math.pi * (step - warm) / max(total - warm, 1))))
        assert lr == pytest.approx(expected, abs=1e-15)
        assert lr <= base + 1e-15


def test_epochs_and_whole_layout(spark):
    assert epochs(ids(spark, 5), 3).groupBy("epoch").count().count() == 3
    plan = lay_out(ids(spark, 100), "doc_id", 4, n_epochs=2)
    assert plan.count() == 200
    assert plan.select("doc_id", "epoch").distinct().count() == 200
    steps = total_steps(F.lit(100), 4)
    assert plan.agg(F.max("opt_step")).first()[0] == spark.range(1).select(steps).first()[0] == 4


def test_no_single_task_over_the_examples(spark):
    """Only the table of part starts may pass through one task."""
    plan = layout.QUERIES["batch_layout"](spark, MEDIUM)._jdf.queryExecution().executedPlan().toString()
    above = plan.split("BroadcastExchange")[0]
    assert "SinglePartition" not in above
    assert plan.count("SinglePartition") <= 1
