"""Allow and block rules for URLs, found by hashed host-suffix and path-prefix expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codequarry.llm.shared import ascii_lower, broadcast_if_small, checkpointed

#: Hex digits of a digest that are joined on, before whole digests are compared.
SHORT = 8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_verdicts(urls: DataFrame, rules: DataFrame, id_column: str = "page_id", url: str = "url",
                 default: str = "allow") -> DataFrame:
    """One row per row of ``urls``: its id, ``host``, ``path``, ``rule`` (host and path joined; null if none) and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all subdomains if the URL's path starts
    with the rule's. The longest rule wins, then the longer host, then the verdict later in the alphabet (``block``).
    Each URL is expanded into its host suffixes, as long as a rule's host can be. The first digits of the SHA-256 of each are joined with those
    of the rules' hosts, then whole digests decide. What is left is expanded into path prefixes, only as long as the paths of that
    host's rules, and joined with the rules in the same way. The best rule is an aggregate by host and path, combined before
    the shuffle, and is joined back by these two values: results do not depend on the order in which rows are read, or read
    again. Rules are broadcast only if few; otherwise a common expression (a third of all URLs under one host) is the many
    side of a join, which adaptive execution splits.

    Null urls, and those without ``://``, have empty host and path, fit no rule and get ``default``. Rules with a null
    host, path or verdict, or an empty host, fit nothing. Repeated rows each get a row; repeated rules change nothing.
    An empty table of rules gives ``default`` everywhere. Only the id column of ``urls`` is kept, whatever else it holds.
    """
    texts = rules.filter("host <> '' AND path IS NOT NULL AND verdict IS NOT NULL").select(
        ascii_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), "verdict"
    )
    expression = lambda host, path: F.sha2(F.concat_ws("\0", host, path), 256)
    known = checkpointed(
        texts.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("rule_verdict"))
        .withColumn("digest", expression(F.col("rule_host"), F.col("rule_path")))
        .withColumn("short", F.substring("digest", 1, SHORT))
    )
    hosts = checkpointed(
        known.groupBy("rule_host").agg(F.sort_array(F.collect_set(F.length("rule_path"))).alias("lengths"))
        .withColumn("host_digest", F.sha2("rule_host", 256)).withColumn("host_short", F.substring("host_digest", 1, SHORT))
    )
    # one row: the label counts that occur, as many as the longest host has labels
    shape = hosts.agg(F.count("*").alias("n"), F.sort_array(F.collect_set(F.size(F.split("rule_host", r"\.")))).alias("labels")).first()
    base = urls.select(F.col(f"`{id_column}`").alias("id"), host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    if not shape["n"]:
        return base.select(F.col("id").alias(id_column), "host", "path", F.lit(None).cast("string").alias("rule"),
                           F.lit(default).alias("verdict"))
    labels = F.array(*[F.lit(n) for n in shape["labels"]])
    suffixes = F.transform(F.filter(labels, lambda n: n <= F.size(F.split("host", r"\."))),
                           lambda n: F.call_function("substring_index", F.col("host"), F.lit("."), -n))
    by_host = base.filter("host <> ''").select("host", "path", F.explode(suffixes).alias("suffix")).withColumn(
        "suffix_digest", F.sha2("suffix", 256)).withColumn("host_short", F.substring("suffix_digest", 1, SHORT))
    near = by_host.join(broadcast_if_small(hosts, shape["n"]), "host_short").filter("suffix_digest = host_digest")
    prefixes = F.transform(F.filter("lengths", lambda n: n <= F.length("path")),
                           lambda n: expression(F.col("suffix"), F.substring(F.col("path"), F.lit(1), n)))
    expanded = near.select("host", "path", F.explode(prefixes).alias("digest")).withColumn("short", F.substring("digest", 1, SHORT))
    found = expanded.alias("e").join(broadcast_if_small(known, known.count()).alias("k"), "short").filter("e.digest = k.digest")
    best = found.groupBy("host", "path").agg(F.max(F.struct(
        F.length(F.concat("rule_host", "rule_path")).alias("size"), F.length("rule_host").alias("host_size"), "rule_verdict",
        F.concat("rule_host", "rule_path").alias("rule"),
    )).alias("best"))
    return base.join(best, ["host", "path"], "left").select(
        F.col("id").alias(id_column), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.rule_verdict"), F.lit(default)).alias("verdict"),
    )
