"""Call sites and callee rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codequarry.functions.limits import first_k, with_totals
from codequarry.operators.matching import has_paths, match_rules, with_names
from codequarry.sources.rules import CALL_RULES, Rule

# Ranked callees and listed calls per file.
TOP_CALLEES = 30
LISTED_CALLS = 500


def calls(nodes: DataFrame, sources: DataFrame | None = None, rules: Sequence[Rule] = CALL_RULES) -> DataFrame:
    """One row per call match: callee name and its 1-based line. PHP names lose their namespace."""
    matched = match_rules(nodes, rules).select(
        "file_id", "language", "name", "name_row", "name_pre", "name_start", "name_end", "kind_pre", "pattern_ix"
    )
    found = with_names(matched, None if has_paths(nodes) else sources)
    plain = F.when(F.col("language") == "php", F.substring_index("name", "\\", -1)).otherwise(F.col("name"))
    return found.filter(F.coalesce("name", F.lit("")) != "").select(
        "file_id", "language", plain.alias("name"), (F.col("name_row") + 1).alias("line"),
        F.col("kind_pre").alias("call_pre"), "pattern_ix", "name_pre",
    )


def callee_counts(found: DataFrame) -> DataFrame:
    """Calls per file and callee, with the place of the first one."""
    return found.groupBy("file_id", "name").agg(F.count(F.lit(1)).alias("n"), F.min("name_pre").alias("first_call"))


def top_callees(found: DataFrame, k: int = TOP_CALLEES) -> DataFrame:
    """The k most called names per file; ties go to the name called first."""
    return first_k(callee_counts(found), ["file_id"], [F.desc("n"), F.asc("first_call")], k).drop("first_call")


def listed_calls(found: DataFrame, limit: int | None = None) -> DataFrame:
    """Calls in order with the file's uncapped ``total``; at most ``limit`` rows per file if one is set."""
    order = [F.col(c) for c in ("name_pre", "call_pre", "pattern_ix")]
    if limit is None:
        ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("file_id").orderBy(*order)))
        return ranked.withColumn("total", F.count(F.lit(1)).over(Window.partitionBy("file_id")))
    return with_totals(first_k(found, ["file_id"], order, limit), found, ["file_id"], "total")


def corpus_top_callees(found: DataFrame, k: int = TOP_CALLEES, by: Sequence[str] = ()) -> DataFrame:
    """The k most called names of the corpus, or of each group of ``by`` columns; ties by name."""
    counts = found.groupBy(*by, "name").agg(F.count(F.lit(1)).alias("n"))
    if by:
        return first_k(counts, list(by), [F.desc("n"), F.asc("name")], k)
    return counts.orderBy(F.desc("n"), F.asc("name")).limit(k)
