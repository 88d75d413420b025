"""Definitions from a node table: rule matches, specificity dedupe, order, counts, per-file results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codequarry.operators.matching import has_paths, match_rules, with_names
from codequarry.sources.languages import languages_with
from codequarry.sources.rules import DEFINITION_RULES, Rule

# The kinds, and the ranks that decide between kinds on one line; all others rank 2.
KINDS = ["function", "class", "method", "interface", "type", "enum", "struct", "trait", "impl", "module",
         "constructor", "export"]
SPECIFIC_KINDS = ["struct", "interface", "class", "enum", "trait"]   # rank 3
GENERIC_KINDS = ["type"]                                             # rank 1

_PART_BITS = 16   # 65,536 nodes


def kind_rank(kind: Column) -> Column:
    return F.when(kind.isin(SPECIFIC_KINDS), 3).when(kind.isin(GENERIC_KINDS), 1).otherwise(2)


def raw_definitions(
    nodes: DataFrame, sources: DataFrame | None = None, rules: Sequence[Rule] = DEFINITION_RULES
) -> DataFrame:
    """Every definition match, before the dedupe; lines are 1-based."""
    allowed = [r for r in rules if r.kind in KINDS]
    # Only what is shown: both ways to a name then read the same columns and share their shuffles.
    matched = match_rules(nodes, allowed).select(
        "file_id", "language", "kind", "name", "name_row", "name_pre", "name_start", "name_end", "kind_pre",
        "kind_start_row", "kind_end_row", "pattern_ix",
    )
    found = with_names(matched, None if has_paths(nodes) else sources)
    return found.filter(F.col("name").isNotNull()).select(
        "file_id", "language", "kind", "name",
        (F.col("kind_start_row") + 1).alias("start_line"), (F.col("kind_end_row") + 1).alias("end_line"),
        "name_row", "kind_pre", "pattern_ix", "name_pre",
    )


def dedupe(defs: DataFrame) -> DataFrame:
    """One definition per (file, start line, name): higher rank wins, ties keep the first match.

    Matches are ordered by construct position, then name position, then rule. ``seen_*`` is the place of
    the first match of the key, which is the place the survivor takes. An aggregate, not a window: a key
    that repeats without end is combined before the shuffle.
    """
    order = F.struct("kind_pre", "name_pre", "pattern_ix")
    best = F.struct(-kind_rank(F.col("kind")), order)
    value = F.struct("language", "kind", "end_line", "name_row", "kind_pre", "pattern_ix", "name_pre")
    return (
        defs.groupBy("file_id", "start_line", "name")
        .agg(F.min_by(value, best).alias("won"), F.min(order).alias("seen"))
        .select(
            "file_id", "won.language", "won.kind", "name", "start_line", "won.end_line", "won.name_row",
            "won.kind_pre", "won.pattern_ix", "won.name_pre",
            F.col("seen.kind_pre").alias("seen_pre"), F.col("seen.pattern_ix").alias("seen_pattern"),
            F.col("seen.name_pre").alias("seen_name"),
        )
    )


def definitions(
    nodes: DataFrame, sources: DataFrame | None = None, rules: Sequence[Rule] = DEFINITION_RULES
) -> DataFrame:
    """Deduplicated definitions of a whole corpus."""
    return dedupe(raw_definitions(nodes, sources, rules))


def match_order() -> list[Column]:
    """Sort key inside a file: by start line, then by first match."""
    return [F.col(c) for c in ("start_line", "seen_pre", "seen_name", "seen_pattern")]


def ordered(defs: DataFrame) -> DataFrame:
    return defs.orderBy("file_id", *match_order())


def count_by_kind(defs: DataFrame) -> DataFrame:
    return defs.groupBy("file_id", "kind").agg(F.count(F.lit(1)).alias("n"))


def file_totals(defs: DataFrame, files: DataFrame) -> DataFrame:
    """``total`` and the map ``by_kind`` (at most 12 entries) per file; files without definitions stay."""
    per_file = count_by_kind(defs).groupBy("file_id").agg(
        F.sum("n").alias("total"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("kind", "n")))).alias("by_kind")
    )
    empty = F.create_map().cast("map<string,bigint>")
    return files.join(per_file, "file_id", "left").select(
        *files.columns, F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("by_kind", empty).alias("by_kind")
    )


def file_results(defs: DataFrame, files: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Per-file totals with the ordered list of definitions.

    A list covers at most 65,536 nodes of a file, so no list grows without bound: a bigger file gives
    several rows, numbered by ``part``, each with the file's totals.
    """
    entry = F.struct(*match_order(), "kind", "name", "end_line", *extra)
    shown = [c for c in ("kind", "name", "start_line", "end_line", *extra)]
    parts = defs.groupBy("file_id", F.shiftright("seen_pre", _PART_BITS).alias("part")).agg(
        F.sort_array(F.collect_list(entry)).alias("entries")
    )
    # Totals come from the parts, so that the definitions are computed once.
    counts = parts.select("file_id", F.explode("entries.kind").alias("kind"))
    totals = file_totals(counts, files)
    lists = parts.select("file_id", "part", F.transform(
        "entries", lambda e: F.struct(*[e[c].alias(c) for c in shown])).alias("definitions"))
    return totals.join(lists, "file_id", "left").withColumn("part", F.coalesce("part", F.lit(0)))


def unsupported(files: DataFrame, family: str = "definition") -> DataFrame:
    """Error rows for files whose language has no rules of the family."""
    return files.filter(~F.col("language").isin(languages_with(family))).select(
        "file_id", F.concat(F.lit(f"no {family} rules for "), F.col("language")).alias("error")
    )
