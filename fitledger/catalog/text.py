"""Queries on examples, chat text and tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fitledger import schemas
from fitledger.catalog.tables import examples, path_of, table
from fitledger.functions import (
    apply_chat_template, build_messages, build_user_text, decode_tokens, null_to_empty, py_strip, tokenize,
)
from fitledger.functions.chat import SYSTEM_PROMPT
from fitledger.functions.text import WHITESPACE
from fitledger.operators.examples import (
    render_examples, render_prompts, replace_columns, token_examples, unused_turns,
)
from fitledger.operators.vocabulary import build_vocabulary, decode_ids, encode, length_profile
from fitledger.session import saved_table, scratch_path
from fitledger.sources.readers import inline_messages, read_examples
from fitledger.sources.sinks import write_training_text

TOP_WORDS = 2_000


def read_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows, and those of one split."""
    path = path_of(sf_dir, "documents")
    everything = read_examples(spark, path, split=None, schema=schemas.DOCUMENTS).withColumn("split", F.lit("all"))
    one = read_examples(spark, path, split="en", split_column="lang", schema=schemas.DOCUMENTS).withColumn("split", F.lit("en"))
    return everything.unionByName(one).select("split", "doc_id", "source", "n_chars", F.md5("text").alias("text_md5"))


def conversation_pairs(spark, sf_dir):
    return examples(spark, sf_dir)


def turns_left_out(spark, sf_dir):
    return unused_turns(table(spark, sf_dir, "conversations"))


def inline_message_list(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    opened = inline_messages(turns, [("system", SYSTEM_PROMPT)], "opening")
    turn = F.array(F.struct(F.col("role"), F.col("text").alias("content")))
    return opened.select(
        "conv_id", "turn",
        apply_chat_template(F.concat("opening", turn)).alias("text"),
    )


def null_as_empty(spark, sf_dir):
    return examples(spark, sf_dir).select(
        "example_id",
        null_to_empty(F.col("input")).alias("input"),
        null_to_empty(F.col("output")).alias("output"),
    )


def strip_whitespace(spark, sf_dir):
    padded = F.concat(F.lit("　\t "), F.col("text"), F.lit(" \u001c\n "))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", py_strip(padded).alias("stripped"))


def user_text(spark, sf_dir):
    return examples(spark, sf_dir).select(
        "example_id", build_user_text(F.col("instruction"), F.col("input")).alias("user_text"))


def replaced_columns(spark, sf_dir):
    return replace_columns(table(spark, sf_dir, "documents"), {
        "doc_id": F.col("doc_id"),
        "tag": F.concat_ws("/", "lang", "source"),
    })


def message_rows(spark, sf_dir):
    messages = build_messages(F.col("instruction"), F.col("input"), F.col("output"))
    return (
        examples(spark, sf_dir).select("example_id", F.posexplode(messages).alias("pos", "m"))
        .select("example_id", F.col("pos").cast("bigint").alias("pos"),
                F.col("m.role").alias("role"), F.col("m.content").alias("content"))
    )


def chat_text(spark, sf_dir):
    return render_examples(examples(spark, sf_dir))


def listed_chat_text(spark, sf_dir):
    messages = build_messages(F.col("instruction"), F.col("input"), F.col("output"))
    listed = examples(spark, sf_dir).select("example_id", messages.alias("messages"))
    return listed.select("example_id", apply_chat_template(F.col("messages")).alias("text"))


def prompts(spark, sf_dir):
    return render_prompts(examples(spark, sf_dir))


def training_text(spark, sf_dir):
    path = scratch_path(spark, "training-text")
    write_training_text(render_examples(examples(spark, sf_dir)), path)
    return spark.read.schema("example_id string, text string").parquet(path)


def document_tokens(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tokenize(F.col("text")).alias("tokens"))


def tokens(spark, sf_dir):
    return (
        document_tokens(spark, sf_dir)
        # Filtered on the output: the optimizer's own filter below would split the text again.
        .select("doc_id", F.posexplode_outer("tokens").alias("pos", "token"))
        .filter(F.col("pos").isNotNull())
        .select("doc_id", F.col("pos").cast("bigint").alias("pos"), "token")
    )


def truncated_tokens(spark, sf_dir):
    cut = token_examples(table(spark, sf_dir, "documents"), "doc_id")
    return cut.select(
        "doc_id", F.col("n_tokens").cast("bigint").alias("n_tokens"), "truncated",
        F.md5(decode_tokens(F.col("tokens"))).alias("text_md5"),
    )


def decoded_tokens(spark, sf_dir):
    return document_tokens(spark, sf_dir).select("doc_id", decode_tokens(F.col("tokens")).alias("text"))


def document_lengths(spark, sf_dir):
    lengths = document_tokens(spark, sf_dir).select(F.size("tokens").alias("n_tokens"))
    profile = length_profile(lengths, [1024, 2048])
    return profile.withColumns({p: F.round(p, 6) for p in ("p50", "p90", "p99")})


def vocabulary(spark, sf_dir):
    return build_vocabulary(document_tokens(spark, sf_dir))


def top_words(spark, sf_dir):
    """The feature is the limit: the most frequent words, ties by word."""
    return build_vocabulary(document_tokens(spark, sf_dir), TOP_WORDS)


def encoded_tokens(spark, sf_dir):
    words = saved_table(vocabulary(spark, sf_dir), "words")
    ids = encode(document_tokens(spark, sf_dir), words, "doc_id")
    return ids.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.size(F.filter("ids", lambda i: i < 0)).cast("bigint").alias("n_unknown"),
        F.md5(F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")).alias("ids_md5"),
    )


def decoded_ids(spark, sf_dir):
    words = saved_table(vocabulary(spark, sf_dir), "words")
    ids = encode(document_tokens(spark, sf_dir), words, "doc_id")
    return decode_ids(ids, words, "doc_id").select("doc_id", F.md5("text").alias("text_md5"))


QUERIES = {
    "read_examples": read_split,
    "conversation_examples": conversation_pairs,
    "unused_turns": turns_left_out,
    "inline_messages": inline_message_list,
    "null_to_empty": null_as_empty,
    "py_strip": strip_whitespace,
    "build_user_text": user_text,
    "replace_columns": replaced_columns,
    "build_messages": message_rows,
    "render_examples": chat_text,
    "apply_chat_template": listed_chat_text,
    "generation_prompt": prompts,
    "write_training_text": training_text,
    "tokenize": tokens,
    "truncate_tokens": truncated_tokens,
    "decode_tokens": decoded_tokens,
    "length_profile": document_lengths,
    "build_vocabulary": vocabulary,
    "top_words": top_words,
    "encode_tokens": encoded_tokens,
    "decode_ids": decoded_ids,
}

_EXAMPLES = """
examples as (
  select coalesce(cast(conv_id as varchar), '') || ':' || coalesce(cast(turn as varchar), '') as example_id,
    text as instruction, system as input, reply as output
  from (
    select *,
      arg_min(case when role = 'system' then text end, case when role = 'system' then turn end)
        over (partition by conv_id) as system,
      case when lead(role) over next_turn = 'assistant' then lead(text) over next_turn end as reply
    from conversations
    window next_turn as (partition by conv_id order by turn)
  ) where role = 'user'
)"""

_PARTS = f"""{_EXAMPLES},
parts as (
  select example_id,
    case when trim(coalesce(input, ''), '{WHITESPACE}') = '' then trim(coalesce(instruction, ''), '{WHITESPACE}')
         else trim(coalesce(instruction, ''), '{WHITESPACE}') || chr(10) || chr(10) || '[入力]' || chr(10)
              || trim(input, '{WHITESPACE}') end as asked,
    trim(coalesce(output, ''), '{WHITESPACE}') as answer
  from examples
)"""

_CHAT = f"""with {_PARTS}
select example_id,
  '<|system|>/no_think<|end|>' || chr(10) || '<|user|>' || asked || '<|end|>' || chr(10)
  || '<|assistant|>' || answer || '<|end|>' as text
from parts"""

_TOKENS = f"""
words as (
  select doc_id,
    list_filter(regexp_split_to_array(text, '[{WHITESPACE}]+'), lambda w: w <> '') as tokens
  from documents
)"""

_VOCABULARY = f"""{_TOKENS},
vocabulary as (
  select token, n, row_number() over (order by n desc, token) - 1 as token_id
  from (select token, count(*) as n from (select unnest(tokens) as token from words) group by token)
),
spread as (
  select doc_id, unnest(tokens) as token, generate_subscripts(tokens, 1) as pos from words
),
encoded as (
  select doc_id, pos, coalesce(token_id, -1) as token_id, coalesce(v.token, '<unk>') as token
  from spread s left join vocabulary v on s.token = v.token
)"""

SQL = {
    "read_examples": """
select 'all' as split, doc_id, source, n_chars, md5(text) as text_md5 from documents
union all
select 'en', doc_id, source, n_chars, md5(text) from documents where lang = 'en'""",
    "conversation_examples": f"with {_EXAMPLES} select example_id, instruction, input, output from examples",
    "unused_turns": """
select conv_id, turn, role, reason from (
  select conv_id, turn, role,
    case role when 'user' then null
      when 'assistant' then case when lag(role) over next_turn is distinct from 'user' then 'no question before' end
      when 'system' then case
        when turn <> min(case when role = 'system' then turn end) over (partition by conv_id) then 'not the first'
        when count(*) filter (where role = 'user') over (partition by conv_id) = 0 then 'no question at all' end
      else 'unknown role' end as reason
  from conversations window next_turn as (partition by conv_id order by turn)
) where reason is not null""",
    "inline_messages": """
select conv_id, turn,
  '<|system|>/no_think<|end|>' || chr(10) || '<|' || role || '|>' || text || '<|end|>' as text
from conversations""",
    "null_to_empty": f"""
with {_EXAMPLES}
select example_id, case when input is null then '' else input end as input,
  case when output is null then '' else output end as output
from examples""",
    "py_strip": f"""
select conv_id, turn, trim(text, '{WHITESPACE}') as stripped from conversations""",
    "build_user_text": f"with {_PARTS} select example_id, asked as user_text from parts",
    "replace_columns": "select doc_id, lang || '/' || source as tag from documents",
    "build_messages": f"""
with {_PARTS}
select example_id, cast(0 as bigint) as pos, 'system' as role, '/no_think' as content from parts
union all select example_id, 1, 'user', asked from parts
union all select example_id, 2, 'assistant', answer from parts""",
    "render_examples": _CHAT,
    "apply_chat_template": _CHAT,
    "generation_prompt": f"""with {_PARTS}
select example_id, '<|system|>/no_think<|end|>' || chr(10) || '<|user|>' || asked || '<|end|>'
  || chr(10) || '<|assistant|>' as prompt
from parts""",
    "write_training_text": _CHAT,
    "tokenize": f"""
with {_TOKENS}
select doc_id, generate_subscripts(tokens, 1) - 1 as pos, unnest(tokens) as token from words""",
    "truncate_tokens": f"""
with {_TOKENS}
select doc_id, least(len(tokens), 2048) as n_tokens, len(tokens) > 2048 as truncated,
  md5(array_to_string(tokens[1:2048], ' ')) as text_md5
from words""",
    "decode_tokens": f"with {_TOKENS} select doc_id, array_to_string(tokens, ' ') as text from words",
    "length_profile": f"""
with {_TOKENS}
select count(*) as examples, cast(sum(n) as bigint) as tokens, max(n) as longest,
  round(quantile_cont(n, 0.5), 6) as p50, round(quantile_cont(n, 0.9), 6) as p90,
  round(quantile_cont(n, 0.99), 6) as p99,
  count(*) filter (where n > 1024) as over_1024, count(*) filter (where n > 2048) as over_2048
from (select len(tokens) as n from words)""",
    "build_vocabulary": f"with {_VOCABULARY} select token, n, token_id from vocabulary",
    "top_words": f"with {_VOCABULARY} select token, n, token_id from vocabulary where token_id < {TOP_WORDS}",
    "encode_tokens": f"""
with {_VOCABULARY}
select doc_id, len(tokens) as n_tokens, coalesce(n_unknown, 0) as n_unknown, md5(coalesce(ids, '')) as ids_md5
from words left join (
  select doc_id, count(*) filter (where token_id < 0) as n_unknown,
    string_agg(cast(token_id as varchar), ' ' order by pos) as ids
  from encoded group by doc_id) using (doc_id)""",
    # Nothing is unknown to the whole vocabulary, so the texts come back.
    "decode_ids": f"with {_TOKENS} select doc_id, md5(array_to_string(tokens, ' ')) as text_md5 from words",
}
