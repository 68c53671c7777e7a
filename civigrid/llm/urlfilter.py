"""URL filters by hashed expressions, in DataFrame operations only.

A URL expands into host suffixes (at label borders) times path prefixes (of the lengths that rules have); expressions
and rules are digested, joined on a short prefix of the digest, confirmed on the whole digest, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civigrid.llm.common import BROADCAST_ROWS, spread, written

#: Hex digits of a digest that the join compares first.
SHORT = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rules_of(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path) as a table."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def expression(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path).cast("binary"), 256)


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """For each page: page_id, host, path, rule (as ``host`` + ``path`` of the rule that wins, else null), verdict.

    A rule fits its host and all subdomains, if the path starts with its path. The longest rule (host and path
    together) wins; among equally long ones the longer host, then the later rule and verdict in string order (block before allow). ``default`` is the verdict where
    no rule fits, null and malformed URLs included. Rules with a null or an empty host never fit. Of a very long URL all
    host suffixes are asked for, and path prefixes up to the longest rule's length. Repeated rows give repeated rows, an
    empty table none; other columns are ignored.
    """
    own = rules.where("host <> '' AND path IS NOT NULL AND verdict IS NOT NULL").select(F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
    own = written(own.withColumn("digest", expression(F.col("r_host"), F.col("r_path"))).withColumn("short", F.substring("digest", 1, SHORT)), "url-rules")
    lengths = sorted(r.n for r in own.select(F.length("r_path").alias("n")).distinct().collect())  # path lengths, not rules
    host, path = parts(F.col("url").cast("string"))
    given = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path")).withColumn("row", F.monotonically_increasing_id())
    labels = F.split("host", r"\.", -1)
    suffixes = F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    prefixes = F.filter(F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths)).cast("array<string>"), lambda p: p.isNotNull())
    pairs = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: expression(h, p))))
    # explode_outer keeps pages without an expression; a page's rows stay in one task until the aggregate has joined them again.
    asked = given.select("row", "page_id", "host", "path", F.explode_outer(pairs).alias("asked")).withColumn("short", F.substring("asked", 1, SHORT))
    # Of many rules, those that a third of all pages ask for are dealt over salts.
    found = asked.join(F.broadcast(own), "short", "left") if own.count() <= BROADCAST_ROWS else spread(asked, own, "short", how="left", by="row")
    fits = F.col("asked") == F.col("digest")
    rank = F.when(fits, F.struct((F.length("r_host") + F.length("r_path")).alias("n"), F.length("r_host").alias("h"), F.struct(F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict")).alias("r")))
    best = found.groupBy("row", "page_id", "host", "path").agg(F.max(rank).alias("best"))
    return best.select("page_id", "host", "path", F.col("best.r.rule").alias("rule"), F.coalesce("best.r.verdict", F.lit(default)).alias("verdict"))
