"""Instruction examples: from conversation turns to rendered training text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from fitledger.functions import ChatTemplate, example_turns, prompt_turns, render_turns, tokenize
from fitledger.functions.tokens import MAX_LENGTH, is_truncated, truncate_tokens
from fitledger.operators.ordered import ROWS_PER_SLOT, with_neighbour


def replace_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Keep only the given new columns; everything they do not use is pruned at the scan."""
    return df.select(*[value.alias(name) for name, value in columns.items()])


def field(df: DataFrame, name: str) -> Column:
    """A column, or null when the table lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def render_examples(df: DataFrame, template: ChatTemplate = ChatTemplate(),
                    id_column: str = "example_id") -> DataFrame:
    """``example_id, text``: one chat-formatted string per example, no row dropped."""
    turns = example_turns(field(df, "instruction"), field(df, "input"), field(df, "output"))
    return replace_columns(df, {
        id_column: F.col(id_column),
        "text": render_turns(turns, template),
    })


def render_prompts(df: DataFrame, template: ChatTemplate = ChatTemplate(),
                   id_column: str = "example_id") -> DataFrame:
    """``example_id, prompt``: the example without its answer, opened for one."""
    turns = prompt_turns(field(df, "instruction"), field(df, "input"))
    return replace_columns(df, {
        id_column: F.col(id_column),
        "prompt": render_turns(turns, template, add_generation_prompt=True),
    })


def token_examples(df: DataFrame, id_column: str, text_column: str = "text",
                   max_length: int = MAX_LENGTH) -> DataFrame:
    """``id, tokens, n_tokens, truncated``: tokens cut to ``max_length``."""
    tokens = tokenize(F.col(text_column))
    return (
        df.select(id_column, tokens.alias("tokens"))
        .withColumn("truncated", is_truncated(F.col("tokens"), max_length))
        .withColumn("tokens", truncate_tokens(F.col("tokens"), max_length))
        .withColumn("n_tokens", F.size("tokens"))
    )


def example_key(conversation: Column, turn: Column) -> Column:
    """``conversation:turn``: different for all turns, however many a conversation has."""
    return F.concat(*[part for column, end in ((conversation, F.lit(":")), (turn, F.lit("")))
                      for part in (F.coalesce(column.cast("string"), F.lit("")), end)])


def first_system_turns(turns: DataFrame) -> DataFrame:
    """``system_conv, system_turn, system_text``: one row for each conversation with a system turn, its first.

    Of several with the first number the one with the least text. Turns without a number come before others. A conversation
    without an id is one like others, so join the result null-safe.
    """
    system = turns.filter(F.col("role") == "system").select("conv_id", "turn", "text")
    first = system.groupBy("conv_id").agg(F.min("turn").alias("turn"), F.count_if(F.col("turn").isNull()).alias("void"))
    first = first.select(F.col("conv_id").alias("system_conv"), F.when(F.col("void") == 0, F.col("turn")).alias("system_turn"))
    # A few rows: only those of the first number are compared by their text.
    there = system.join(first, F.col("conv_id").eqNullSafe(F.col("system_conv")) & F.col("turn").eqNullSafe(F.col("system_turn")))
    return there.groupBy("system_conv", "system_turn").agg(F.min("text").alias("system_text"))


def conversation_examples(turns: DataFrame, rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """One example per user turn: its text, the conversation's system text, the reply.

    The output is null when the next turn is not the assistant's. No user turn is dropped or doubled, however
    many system turns there are. Turns that no example uses are what :func:`unused_turns` returns.
    """
    system = first_system_turns(turns).select("system_conv", F.col("system_text").alias("input"))
    asked = with_neighbour(turns, ["conv_id"], ["turn"], ["role", "text"], "reply", +1,
                           rows_per_slot).filter(F.col("role") == "user")
    return asked.join(system, F.col("conv_id").eqNullSafe(F.col("system_conv")), "left").select(
        example_key(F.col("conv_id"), F.col("turn")).alias("example_id"),
        F.col("text").alias("instruction"),
        "input",
        F.when(F.col("reply.role") == "assistant", F.col("reply.text")).alias("output"),
    )


def unused_turns(turns: DataFrame, rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """``conv_id, turn, role, reason`` of the turns that are in no example.

    An assistant's turn is used right after a user's, a system turn when it is the first
    of a conversation in which a user speaks, a user's turn always. Other roles are unknown.
    """
    placed = with_neighbour(turns, ["conv_id"], ["turn"], ["role"], "before", -1, rows_per_slot)
    asked = turns.filter(F.col("role") == "user").select(F.col("conv_id").alias("asking_conv")).distinct().withColumn("asked", F.lit(True))
    is_first = F.col("turn").eqNullSafe(F.col("system_turn")) & F.col("text").eqNullSafe(F.col("system_text"))
    reason = (
        F.when(F.col("role") == "user", None)
        .when(F.col("role") == "assistant", F.when(~F.coalesce(F.col("before.role") == "user", F.lit(False)), "no question before"))
        .when(F.col("role") == "system", F.when(~is_first, "not the first").when(
            F.col("asked").isNull(), "no question at all"))
        .otherwise("unknown role")
    )
    return (
        placed.join(first_system_turns(turns), F.col("conv_id").eqNullSafe(F.col("system_conv")), "left")
        .join(asked, F.col("conv_id").eqNullSafe(F.col("asking_conv")), "left")
        .select("conv_id", "turn", "role", reason.alias("reason")).filter(F.col("reason").isNotNull())
    )
