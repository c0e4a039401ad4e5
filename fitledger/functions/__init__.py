"""Column functions: text cleaning, chat rendering, tokens, numbers, schedules."""

from fitledger.functions.chat import (
    ChatTemplate, apply_chat_template, build_messages, example_turns, literal_messages,
    prompt_turns, render_turns,
)
from fitledger.functions.numbers import is_number, number_of
from fitledger.functions.schedule import learning_rate, total_steps
from fitledger.functions.text import build_user_text, first_present, null_to_empty, py_strip
from fitledger.functions.tokens import decode_tokens, is_truncated, tokenize, truncate_tokens

__all__ = [
    "ChatTemplate", "apply_chat_template", "build_messages", "build_user_text",
    "decode_tokens", "example_turns", "first_present", "is_number", "is_truncated", "learning_rate",
    "literal_messages", "null_to_empty", "number_of", "prompt_turns", "py_strip",
    "render_turns", "tokenize", "total_steps", "truncate_tokens",
]
