"""Chat messages and their rendering to one string."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from fitledger.functions.text import build_user_text, null_to_empty, py_strip

# Fixed value: the system turn of every example and prompt.
SYSTEM_PROMPT = "/no_think"


@dataclass(frozen=True)
class ChatTemplate:
    """How a message is written out: ``<|role|>content<|end|>``, one message per line."""

    role_prefix: str = "<|"
    role_suffix: str = "|>"
    end: str = "<|end|>"
    separator: str = "\n"
    answering_role: str = "assistant"


Turns = Sequence[tuple[str, Column]]


def literal_messages(rows: Sequence[tuple[str, str]]) -> Column:
    """A message list given in the program: ``[(role, content), ..]``."""
    return _as_list([(role, F.lit(content)) for role, content in rows])


def example_turns(instruction: Column, input_text: Column, output: Column) -> Turns:
    """System, user and assistant turn of an example; an empty answer keeps its turn."""
    return [
        *prompt_turns(instruction, input_text),
        ("assistant", py_strip(null_to_empty(output))),
    ]


def prompt_turns(instruction: Column, input_text: Column) -> Turns:
    """The turns a model is asked with."""
    return [("system", F.lit(SYSTEM_PROMPT)), ("user", build_user_text(instruction, input_text))]


def build_messages(instruction: Column, input_text: Column, output: Column) -> Column:
    """The turns of an example as a message list."""
    return _as_list(example_turns(instruction, input_text, output))


def apply_chat_template(
    messages: Column,
    template: ChatTemplate = ChatTemplate(),
    add_generation_prompt: bool = False,
) -> Column:
    """Render a message list; the generation prompt opens the assistant's turn for inference."""
    lines = F.transform(
        messages, lambda m: _line(template, m["role"], null_to_empty(m["content"])))
    return _closed(template, F.array_join(lines, template.separator), add_generation_prompt)


def render_turns(
    turns: Turns,
    template: ChatTemplate = ChatTemplate(),
    add_generation_prompt: bool = False,
) -> Column:
    """What :func:`apply_chat_template` gives when the number of turns is known.

    Plain concatenation, which is compiled together with the rest of the stage;
    a higher-order function over an array would not be.
    """
    lines = [_line(template, F.lit(role), content) for role, content in turns]
    return _closed(template, F.concat_ws(template.separator, *lines), add_generation_prompt)


def _line(template: ChatTemplate, role: Column, content: Column) -> Column:
    return F.concat(F.lit(template.role_prefix), role, F.lit(template.role_suffix),
                    content, F.lit(template.end))


def _closed(template: ChatTemplate, text: Column, add_generation_prompt: bool) -> Column:
    if not add_generation_prompt:
        return text
    opening = template.role_prefix + template.answering_role + template.role_suffix
    return F.concat(text, F.lit(template.separator + opening))


def _as_list(turns: Turns) -> Column:
    return F.array(*[
        F.struct(F.lit(role).alias("role"), content.alias("content")) for role, content in turns
    ])
