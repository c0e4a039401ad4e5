"""Length profiles kept per append: stored sketches that merge, so that an append reads only its own rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: the accuracy parameter of the sketches. Ranks are within about 0.7 % with 99 % confidence.
ACCURACY = 400
RANK_ERROR = 0.01
SCHEMA = "part string, examples bigint, tokens bigint, longest bigint, lengths binary"


def append_lengths(df: DataFrame, path: str, part: str, length_column: str = "n_tokens", groups: int = 1) -> None:
    """Append the sketch of some examples' lengths under the name of their ``part``.

    One aggregate over these rows alone. With ``groups`` the rows are dealt over so many sketches (say one for each rank),
    which come together when they are read. Without rows there is no sketch.
    """
    length = F.col(length_column).cast("bigint")
    rows = df.select(length.alias("n")).filter(F.col("n").isNotNull())
    dealt = rows.withColumn("group", F.pmod(F.xxhash64("n", F.monotonically_increasing_id()), F.lit(groups)))
    dealt.groupBy("group").agg(
        F.lit(part).alias("part"), F.count(F.lit(1)).alias("examples"), F.sum("n").alias("tokens"),
        F.max("n").alias("longest"), F.kll_sketch_agg_bigint("n", F.lit(ACCURACY)).alias("lengths"),
    ).drop("group").write.mode("append").parquet(path)


def read_lengths(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def merged_profile(sketches: DataFrame, caps: Sequence[int], percentiles: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """One row: examples, tokens, longest, percentiles, and how many examples each cap would cut.

    Counts, sums and the longest are exact; percentiles and cuts are those of the merged sketch, whose ranks are
    off by ``RANK_ERROR`` of the examples at most, with a confidence of 99 %. Without sketches all is null.
    """
    whole = sketches.agg(
        F.sum("examples").alias("examples"), F.sum("tokens").alias("tokens"), F.max("longest").alias("longest"),
        F.kll_merge_agg_bigint("lengths", F.lit(ACCURACY)).alias("lengths"))
    at = {f"p{round(p * 100)}": F.kll_sketch_get_quantile_bigint("lengths", F.lit(float(p))) for p in percentiles}
    over = {f"over_{cap}": F.round(F.col("examples") * (1 - F.kll_sketch_get_rank_bigint("lengths", F.lit(cap).cast("bigint"))))
            .cast("bigint") for cap in caps}
    # An empty sketch has no quantiles.
    some = F.col("examples") > 0
    return whole.select("examples", "tokens", "longest", *[F.when(some, c).alias(n) for n, c in (at | over).items()])
