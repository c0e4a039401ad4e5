"""Queries on the batch layout: 4 ranks, batches of 1, 8 micro-batches per step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fitledger.catalog.tables import examples, table
from fitledger.catalog.text import SQL as TEXT_SQL
from fitledger.operators.examples import render_examples, token_examples
from fitledger.plans import (
    assign_rank, assign_step, batch_summary, epochs, example_index, lay_out, steps_per_epoch,
    with_learning_rate,
)

WORLD = 4


def _indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return example_index(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


def index(spark, sf_dir):
    return _indexed(spark, sf_dir)


def ranks(spark, sf_dir):
    return assign_rank(_indexed(spark, sf_dir), WORLD).select("doc_id", "idx", "rank")


def steps(spark, sf_dir):
    return assign_step(_indexed(spark, sf_dir), WORLD).select("doc_id", "idx", "micro", "opt_step")


def epoch_rows(spark, sf_dir):
    return epochs(_indexed(spark, sf_dir), 3).select("doc_id", "idx", "epoch")


def step_count(spark, sf_dir):
    return steps_per_epoch(table(spark, sf_dir, "documents"), WORLD)


def rates(spark, sf_dir):
    stepped = assign_step(_indexed(spark, sf_dir), WORLD)
    rated = with_learning_rate(stepped, WORLD)
    return rated.select("doc_id", "opt_step", F.round("learning_rate", 12).alias("learning_rate"))


def _sized(spark, sf_dir):
    cut = token_examples(table(spark, sf_dir, "documents"), "doc_id")
    return cut.select("doc_id", F.col("n_tokens").cast("bigint").alias("n_tokens"))


def layout(spark, sf_dir):
    plan = lay_out(_sized(spark, sf_dir), "doc_id", WORLD, n_epochs=2)
    return plan.select(
        "doc_id", "n_tokens", "epoch", "idx", "rank", "micro", "opt_step",
        F.round("learning_rate", 12).alias("learning_rate"),
    )


def conversation_layout(spark, sf_dir):
    """The whole way from conversation turns to a batch plan of their rendered text."""
    text = render_examples(examples(spark, sf_dir))
    sized = token_examples(text, "example_id").select("example_id", "n_tokens")
    plan = lay_out(sized, "example_id", WORLD)
    return plan.select("example_id", "n_tokens", "idx", "rank", "opt_step",
                       F.round("learning_rate", 12).alias("learning_rate"))


def summary(spark, sf_dir):
    plan = assign_step(assign_rank(example_index(_sized(spark, sf_dir), "doc_id"), WORLD), WORLD)
    return batch_summary(plan)


QUERIES = {
    "example_index": index,
    "assign_rank": ranks,
    "assign_step": steps,
    "epochs": epoch_rows,
    "steps_per_epoch": step_count,
    "learning_rate": rates,
    "batch_layout": layout,
    "batch_summary": summary,
    "conversation_layout": conversation_layout,
}

_ORDERED = """
ordered as (
  select doc_id, text, count(*) over () as n_examples,
    row_number() over (order by md5('42:' || doc_id), doc_id) - 1 as idx
  from documents
),
placed as (
  select doc_id, text, n_examples, idx, cast(idx % 4 as integer) as rank, idx // 4 as micro,
    idx // 32 + 1 as opt_step, (n_examples + 31) // 32 as steps
  from ordered
)"""


def _rate(step: str, total: str) -> str:
    warm = f"ceil({total} * 0.03)"
    return f"""round(case when {step} < {warm} then 0.0002 * {step} / greatest({warm}, 1)
    else 0.0001 * (1 + cos(pi() * ({step} - {warm}) / greatest({total} - {warm}, 1))) end, 12)"""


_N_TOKENS = r"""least(2048, len(list_filter(
    regexp_split_to_array(text, '[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+'),
    lambda w: w <> '')))"""

_SIZES = f"sizes as (select doc_id, {_N_TOKENS} as n_tokens from documents)"

SQL = {
    "example_index": f"with {_ORDERED} select doc_id, idx, n_examples from ordered",
    "assign_rank": f"with {_ORDERED} select doc_id, idx, rank from placed",
    "assign_step": f"with {_ORDERED} select doc_id, idx, micro, opt_step from placed",
    "epochs": f"with {_ORDERED} select doc_id, idx, cast(e as integer) as epoch from ordered, range(1, 4) t(e)",
    "steps_per_epoch": """
select count(*) as n_examples, cast(ceil(ceil(count(*) / 4) / 8) as bigint) as steps from documents""",
    "learning_rate": f"""
with {_ORDERED}
select doc_id, opt_step, {_rate("(opt_step - 1)", "steps")} as learning_rate from placed""",
    "batch_layout": f"""
with {_ORDERED}, {_SIZES}
select doc_id, n_tokens, cast(e as integer) as epoch, idx, rank, micro, opt_step,
  {_rate("((e - 1) * steps + opt_step - 1)", "(2 * steps)")} as learning_rate
from placed join sizes using (doc_id), range(1, 3) t(e)""",
    "conversation_layout": f"""
with texts as ({TEXT_SQL["render_examples"]}),
ordered as (
  select example_id, cast({_N_TOKENS} as integer) as n_tokens,
    row_number() over (order by md5('42:' || example_id), example_id) - 1 as idx,
    (count(*) over () + 31) // 32 as steps
  from texts
)
select example_id, n_tokens, idx, cast(idx % 4 as integer) as rank, idx // 32 + 1 as opt_step,
  {_rate("(idx // 32)", "steps")} as learning_rate
from ordered""",
    "batch_summary": f"""
with {_ORDERED}, {_SIZES}
select opt_step, rank, count(*) as examples, cast(sum(n_tokens) as bigint) as tokens
from placed join sizes using (doc_id) group by opt_step, rank""",
}
