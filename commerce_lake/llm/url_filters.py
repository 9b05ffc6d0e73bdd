"""Block and allow lists for URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of a digest that rules are first looked up by (32 bits).
SHORT = 8


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(urls: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow") -> DataFrame:
    """Add host, path, rule and verdict to every row of `urls`.

    `rules` has host, path and action (allow or block). A rule fits its host and all its
    subdomains if the URL's path starts with the rule's. The longest rule (host and path
    together) wins; of equally long ones the longer host, then block. `rule` is its host and
    path, null if none fits; the verdict is then `default`.

    Each distinct (host, path) is expanded into the host suffixes and path prefixes of those
    sizes that rules have (sizes are bounded by the longest rule, not by the number of rules),
    looked up by the first 32 bits of a digest, and confirmed by the whole digest.

    Null, empty and malformed URLs have an empty host and path, which fit no rule with a host.
    Repeated rows are each judged. Rules with a null part are left out; a repeated rule counts
    once. Columns of `urls` named host, path, rule or verdict are replaced.
    """
    rules = rules.where("host IS NOT NULL AND path IS NOT NULL AND action IS NOT NULL").select(
        F.col("host").alias("rule_host"),
        F.col("path").alias("rule_path"),
        F.col("action").alias("action"),
        F.size(F.split("host", r"\.")).alias("labels"),
        F.length("path").alias("length"),
    )
    shapes = rules.select("labels", "length").distinct().collect()
    labels = sorted({r["labels"] for r in shapes}) or [1]
    lengths = sorted({r["length"] for r in shapes}) or [0]
    known = rules.select("rule_host", "rule_path", "action", _digest(F.col("rule_host"), F.col("rule_path")).alias("rule_digest"))
    known = known.withColumn("short", F.substring("rule_digest", 1, SHORT))

    judged = urls.drop("host", "path", "rule", "verdict")
    judged = judged.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    asked = (
        judged.select("host", "path")
        .distinct()
        .withColumn("n", F.size(F.split("host", r"\.")))
        .withColumn("k", F.explode(F.array(*map(F.lit, labels))))
        .where("k <= n")
        .withColumn("m", F.explode(F.array(*map(F.lit, lengths))))
        .where("m <= length(path)")
        .withColumn("digest", _digest(F.expr("substring_index(host, '.', -k)"), F.expr("substring(path, 1, m)")))
        .withColumn("short", F.substring("digest", 1, SHORT))
    )
    fitting = asked.join(known, "short").where("digest = rule_digest")
    best = fitting.groupBy("host", "path").agg(
        F.max(
            F.struct(
                (F.length("rule_host") + F.length("rule_path")).alias("size"),
                F.length("rule_host").alias("host_size"),
                (F.col("action") == "block").alias("blocks"),
                F.concat("rule_host", "rule_path").alias("rule"),
                F.col("action").alias("action"),
            )
        ).alias("best_")
    )
    return judged.join(best, ["host", "path"], "left").select(
        *[c for c in judged.columns],
        F.col("best_.rule").alias("rule"),
        F.coalesce("best_.action", F.lit(default)).alias("verdict"),
    )
