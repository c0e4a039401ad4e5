"""Golden rows of the text rules, and properties of chat text and tokens."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from fitledger import schemas
from fitledger.catalog import tables
from fitledger.functions import (
    ChatTemplate, apply_chat_template, build_messages, build_user_text, first_present,
    literal_messages, null_to_empty, py_strip, tokenize,
)
from fitledger.functions.text import WHITESPACE
from fitledger.operators.examples import (
    conversation_examples, render_examples, token_examples, unused_turns,
)
from fitledger.sources.readers import message_table, read_examples
from fitledger.sources.sinks import write_training_text
from conftest import MEDIUM, SMALL

HEAD = "\n\n[入力]\n"
GOLDEN = [
    ("日本の首都はどこですか？", "", "東京でござる", "日本の首都はどこですか？", "東京でござる"),
    ("A", "B", "C", "A" + HEAD + "B", "C"),
    ("A", None, "C", "A", "C"),
    ("A", "   ", "C", "A", "C"),
    ("A", "　", "C", "A", "C"),
    ("　A　", "B", "C", "A" + HEAD + "B", "C"),
    ("\u001cA ", None, "\tC\n", "A", "C"),
    (None, None, None, "", ""),
    (None, "B", "C", HEAD + "B", "C"),
    ("", "", "", "", ""),
    ("A b  c", None, "C", "A b  c", "C"),
    ("A", " B\nB2 ", "C", "A" + HEAD + "B\nB2", "C"),
    ("​A", None, "C", "​A", "C"),
    ("A <|end|>", None, "C", "A <|end|>", "C"),
]


@pytest.fixture(scope="module")
def golden(spark):
    rows = [(i, *row[:3]) for i, row in enumerate(GOLDEN)]
    return spark.createDataFrame(rows, "example_id bigint, instruction string, input string, output string")


def test_whitespace_is_pythons():
    assert sorted(WHITESPACE) == [chr(c) for c in range(0x110000) if chr(c).isspace()]
    assert len(WHITESPACE) == 29


def test_user_text(golden):
    got = golden.select("example_id", build_user_text(F.col("instruction"), F.col("input")))
    assert [r[1] for r in sorted(got.collect())] == [g[3] for g in GOLDEN]


def test_answer_and_null_to_empty(golden):
    got = golden.select("example_id", py_strip(null_to_empty(F.col("output"))))
    assert [r[1] for r in sorted(got.collect())] == [g[4] for g in GOLDEN]


def test_rendering(golden):
    got = render_examples(golden).collect()
    expected = [
        f"<|system|>/no_think<|end|>\n<|user|>{user}<|end|>\n<|assistant|>{answer}<|end|>"
        for *_, user, answer in GOLDEN
    ]
    assert [r["text"] for r in sorted(got)] == expected


def test_missing_columns_equal_nulls(spark):
    df = spark.createDataFrame([(1, "A")], "example_id bigint, instruction string")
    assert render_examples(df).first()["text"].endswith("<|user|>A<|end|>\n<|assistant|><|end|>")


def test_generation_prompt_and_own_template(spark):
    messages = literal_messages([("system", "/no_think"), ("user", "hi")])
    row = spark.range(1).select(
        apply_chat_template(messages, add_generation_prompt=True).alias("a"),
        apply_chat_template(messages, ChatTemplate("[", "]", "", " ", "bot"), True).alias("b"),
    ).first()
    assert row.a == "<|system|>/no_think<|end|>\n<|user|>hi<|end|>\n<|assistant|>"
    assert row.b == "[system]/no_think [user]hi [bot]"


def test_pad_falls_back_to_end(spark):
    df = spark.createDataFrame([(None, 2), (7, 2)], "pad int, eos int")
    assert [r[0] for r in df.select(first_present(F.col("pad"), F.col("eos"))).collect()] == [2, 7]


def test_tokens_are_pythons_split(spark):
    texts = ["", "  ", " a b　c\x1cd ", "x​y", None, "one", "a\n\n\tb c\u0085d"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = [r[0] for r in df.orderBy("i").select(tokenize(F.col("text"))).collect()]
    assert got == [None if t is None else t.split() for t in texts]


def test_token_cap(spark):
    docs = tables.table(spark, MEDIUM, "documents")
    row = token_examples(docs, "doc_id").agg(
        F.max("n_tokens"), F.count_if("truncated"), F.count("*")).first()
    assert tuple(row) == (2048, 19, 1000)


@pytest.mark.parametrize("sf_dir,counts", [(SMALL, (48, 14, 8)), (MEDIUM, (279, 46, 62))])
def test_conversation_examples(spark, sf_dir, counts):
    found = tables.examples(spark, sf_dir)
    row = found.agg(F.count("*"), F.count_if(F.col("output").isNull()), F.count("input")).first()
    assert tuple(row) == counts


def test_one_huge_conversation(spark):
    """A conversation cut into slots gives the same examples as in one piece."""
    turns = tables.table(spark, SMALL, "conversations")
    huge = turns.select(
        F.lit(1).cast("bigint").alias("conv_id"),
        (F.col("conv_id") * 10 + F.col("turn")).alias("turn"), "role", "text",
    ).unionByName(turns.select(F.col("conv_id") + 100, "turn", "role", "text").toDF(*turns.columns))
    whole = conversation_examples(huge).collect()
    cut = conversation_examples(huge, rows_per_slot=9).collect()
    assert sorted(whole) == sorted(cut)


def test_text_path_stays_in_the_jvm(spark):
    plan = render_examples(tables.examples(spark, SMALL))._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_read_examples_by_column_and_folder(spark, tmp_path):
    rows = [("a", None, "x", "train"), ("b", "i", "y", "test"), ("c", "", None, "train")]
    df = spark.createDataFrame(rows, "instruction string, input string, output string, split string")
    df.write.parquet(str(tmp_path / "flat"))
    df.write.partitionBy("split").json(str(tmp_path / "folders"))
    expected = sorted([r[:3] for r in rows if r[3] == "train"], key=repr)
    flat = read_examples(spark, str(tmp_path / "flat"))
    folders = read_examples(spark, str(tmp_path / "folders"), fmt="json")
    assert sorted(map(tuple, flat.collect()), key=repr) == expected
    assert sorted(map(tuple, folders.collect()), key=repr) == expected
    assert flat.schema == schemas.EXAMPLES
    assert "PushedFilters: [IsNotNull(split), EqualTo(split,train)]" in flat._jdf.queryExecution().toString()
    everything = read_examples(spark, str(tmp_path / "flat"), split=None)
    assert everything.count() == 3


def test_training_text_formats(spark, tmp_path, golden):
    rendered = render_examples(golden)
    write_training_text(rendered, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == len(GOLDEN)
    one_line = rendered.withColumn("text", F.replace("text", F.lit("\n"), F.lit("\\n")))
    write_training_text(one_line, str(tmp_path / "t"), fmt="text")
    assert spark.read.text(str(tmp_path / "t")).count() == len(GOLDEN)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.text(alphabet=WHITESPACE + "ab\u200b日\U0001f600", max_size=12), min_size=1, max_size=40))
def test_strip_and_split_are_pythons(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = df.select("i", py_strip(F.col("text")), tokenize(F.col("text"))).collect()
    assert sorted(map(tuple, got)) == [(i, t.strip(), t.split()) for i, t in enumerate(texts)]


def test_literal_message_table(spark):
    rows = [("system", "/no_think"), ("user", "hi")]
    assert [tuple(r) for r in message_table(spark, rows).collect()] == rows


def test_messages_shape(golden):
    df = golden.select(build_messages(F.col("instruction"), F.col("input"), F.col("output")).alias("m"))
    assert df.schema["m"].dataType.elementType.names == schemas.MESSAGE.names
    assert {r[0] for r in df.select(F.size("m")).collect()} == {3}


def test_keys_of_long_conversations_differ(spark):
    turns = spark.createDataFrame(
        [(1, 1000, "user", "a"), (2, 0, "user", "b"), (2**62, 2**62, "user", "c"), (None, 5, "user", "d")],
        "conv_id bigint, turn bigint, role string, text string")
    keys = [r["example_id"] for r in conversation_examples(turns).collect()]
    assert sorted(keys) == sorted({"1:1000", "2:0", f"{2**62}:{2**62}", ":5"})


def test_turns_that_no_example_uses(spark):
    roles = ["system", "system", "user", "assistant", "assistant", "user", "tool", "assistant", "user"]
    rows = [(1, i, role, f"t{i}") for i, role in enumerate(roles)] + [(2, 0, "system", "s"), (2, 1, "assistant", "x")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    left = {(r["conv_id"], r["turn"]): r["reason"] for r in unused_turns(turns).collect()}
    assert left == {(1, 1): "not the first", (1, 4): "no question before", (1, 6): "unknown role",
                    (1, 7): "no question before", (2, 0): "no question at all", (2, 1): "no question before"}
    used = conversation_examples(turns).collect()
    texts = [t for r in used for t in (r["instruction"], r["output"]) if t is not None] + [
        s for s in {r["input"] for r in used if r["input"] is not None}]
    assert len(texts) + len(left) == len(rows)


def test_no_example_is_doubled_by_system_turns(spark):
    rows = [(3, 0, "system", "y"), (3, 0, "system", "x"), (3, 0, "system", "x"), (3, 1, "user", "q"), (3, 2, "assistant", "a"),
            (None, 0, "system", "null conversation"), (None, 1, "user", "nq"), (4, None, "system", "no number"), (4, 2, "system", "later"),
            (4, 3, "user", "q4"), (5, 1, "user", "q5"), (6, 0, "system", None), (6, 1, "user", "q6")]
    turns = spark.createDataFrame(rows, schemas.CONVERSATIONS)
    got = sorted((r.example_id, r.instruction, r.input, r.output) for r in conversation_examples(turns).collect())
    assert got == [("3:1", "q", "x", "a"), ("4:3", "q4", "no number", None), ("5:1", "q5", None, None), ("6:1", "q6", None, None),
                   (":1", "nq", "null conversation", None)]
    left = sorted(((r.conv_id, r.turn, r.reason) for r in unused_turns(turns).collect()), key=str)
    assert left == [(3, 0, "not the first"), (4, 2, "not the first")]
    assert conversation_examples(turns.limit(0)).count() == 0
