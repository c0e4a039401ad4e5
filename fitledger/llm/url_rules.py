"""URL filters: host-suffix and path-prefix expressions, hash prefixes, full digests, precedence."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fitledger.session import broadcast_if_small

PREFIX_DIGITS = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url):
    """Host (A-Z lower-cased) and path of a URL column; both empty for null or without ``://``."""
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    known = F.coalesce(F.locate("://", url) > 0, F.lit(False))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.when(known, host).otherwise(""), F.when(known, path).otherwise("")


def prepared_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with digest, hash prefix and precedence, one row for each host and path.

    The longest rule wins, then the one with the longer host; of two verdicts for one
    rule ``block`` wins. The precedence packs length, host length and verdict into a long.
    """
    host = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER)
    path = F.coalesce("path", F.lit(""))
    rule = F.concat(host, path)
    blocks = (F.col("verdict") == "block").cast("long")
    return (
        rules.select(rule.alias("rule"), F.length(host).alias("host_length"),
                     F.when(host == "", 0).otherwise(F.size(F.split(host, "\\."))).alias("labels"),
                     F.length(path).alias("path_length"), blocks.alias("blocks"))
        .groupBy("rule", "host_length", "labels", "path_length").agg(F.max("blocks").alias("blocks"))
        .withColumn("digest", F.sha2("rule", 256))
        .withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))
        .withColumn("precedence", F.shiftleft(F.length("rule").cast("long"), 32)
                    + F.shiftleft(F.col("host_length").cast("long"), 1) + F.col("blocks"))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url",
               default: str = "allow") -> DataFrame:
    """One row (id, host, path, rule, verdict) for each input row.

    A rule fits its host and all subdomains where the path starts with the rule's path.
    Each different (host, path) is judged once: it is expanded into the host suffixes and
    path prefixes of the sizes that rules have, these meet the rules on a short hash prefix,
    and the full digest confirms. No rule: ``rule`` is null and the verdict is ``default``.
    Null urls and urls without ``://`` have an empty host and path and fit no rule with a host.
    Repeated rows stay repeated; other columns are ignored; an empty rule table allows all.
    """
    host, path = host_and_path(F.col(url_column))
    rows = pages.select(F.col(id_column).alias(id_column), host.alias("host"), path.alias("path"))
    known = prepared_rules(rules)
    sizes = known.agg(F.collect_set("labels"), F.collect_set("path_length")).first()
    labels, lengths = sorted(sizes[0]), sorted(sizes[1])
    if not labels:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})

    suffixes = F.array_distinct(F.array(*[
        F.lit("") if n == 0 else F.substring_index("host", ".", -n) for n in labels]))
    prefixes = F.filter(F.array(*[
        F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]), lambda p: p.isNotNull())
    sites = rows.select("host", "path").distinct()
    expressions = (
        sites.select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("host", "path", F.explode("prefixes").alias("prefix"), "suffix")
        .select("host", "path", F.sha2(F.concat("suffix", "prefix"), 256).alias("found"))
        .withColumn("short", F.substring("found", 1, PREFIX_DIGITS))
    )
    best = (
        expressions.join(broadcast_if_small(known.select("short", "digest", "precedence")), "short")
        .where(F.col("found") == F.col("digest"))
        .groupBy("host", "path").agg(F.max("precedence").alias("precedence"))
    )
    # The winning rule is a host suffix and a path prefix, so its text follows from its lengths.
    length = F.shiftright("precedence", 32).cast("int")
    host_length = F.shiftright(F.col("precedence").bitwiseAND((1 << 32) - 1), 1).cast("int")
    rule = F.concat(F.substring("host", F.length("host") - host_length + 1, host_length),
                    F.substring("path", F.lit(1), length - host_length))
    verdict = (F.when(F.col("precedence").isNull(), default)
               .when(F.col("precedence").bitwiseAND(1) == 1, "block").otherwise("allow"))
    return rows.join(best, ["host", "path"], "left").select(
        id_column, "host", "path", F.when(F.col("precedence").isNotNull(), rule).alias("rule"),
        verdict.alias("verdict"))
