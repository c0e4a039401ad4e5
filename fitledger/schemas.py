"""Explicit schemas of the tables the library reads and writes."""

from pyspark.sql import types as T

EXAMPLES = T.StructType([
    T.StructField("instruction", T.StringType()),
    T.StructField("input", T.StringType()),
    T.StructField("output", T.StringType()),
])

MESSAGE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
])

CONVERSATIONS = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
])

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

LOG_EVENTS = T.StructType([
    T.StructField("run_id", T.LongType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("step", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("logs", T.StringType()),
])

# Log rows as they are stored: the entry parsed once, and what could not be read with its text and why.
LOG_ROWS = T.StructType([
    T.StructField("run_id", T.LongType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("step", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("entry", T.VariantType()),
    T.StructField("line", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("file", T.StringType()),
])

METRICS = T.StructType([
    T.StructField("run_id", T.LongType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("step", T.LongType()),
    T.StructField("log_time", T.TimestampType()),
])

RUNS = T.StructType([
    T.StructField("run_id", T.LongType()),
    T.StructField("experiment", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("username", T.StringType()),
])

PARAMS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("value_type", T.StringType()),
])
