"""Import statements and the file-to-module graph they form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codequarry.functions.text import CLIP_CHARS, unquote
from codequarry.operators.lines import cut_clipped
from codequarry.operators.matching import has_paths, match_rules, with_names
from codequarry.sources.rules import IMPORT_RULES, Rule


def imports(nodes: DataFrame, sources: DataFrame | None, rules: Sequence[Rule] = IMPORT_RULES) -> DataFrame:
    """One row per import match: unquoted module, 1-based statement line, clipped statement text (null without ``sources``)."""
    matched = match_rules(nodes, rules).select(
        "file_id", "language", "name", "name_pre", "name_start", "name_end", "kind_pre", "kind_start_row",
        "kind_start_idx", "kind_end_idx", "pattern_ix",
    )
    found = with_names(matched, None if has_paths(nodes) else sources)
    if sources is None:
        found = found.withColumn("raw", F.lit(None).cast("string"))
    else:
        found = cut_clipped(found, sources, "kind_start_idx", "kind_end_idx", CLIP_CHARS, "raw")
    return found.select(
        "file_id", "language", unquote(F.col("name")).alias("module"), (F.col("kind_start_row") + 1).alias("line"),
        "raw", F.col("kind_pre").alias("import_pre"), "pattern_ix", "name_pre",
    )


def import_edges(found: DataFrame) -> DataFrame:
    """Edges file -> module with their number of statements."""
    return found.filter(F.col("module").isNotNull()).groupBy("file_id", "module").agg(
        F.count(F.lit(1)).alias("n_imports")
    )


def module_degrees(edges: DataFrame) -> DataFrame:
    """How many files import a module, and by how many statements."""
    return edges.groupBy("module").agg(
        F.count(F.lit(1)).alias("in_degree"), F.sum("n_imports").alias("n_imports")
    )


def file_degrees(edges: DataFrame, files: DataFrame) -> DataFrame:
    """How many modules a file imports; files without imports stay with 0."""
    out = edges.groupBy("file_id").agg(F.count(F.lit(1)).alias("out_degree"))
    return files.select("file_id").join(out, "file_id", "left").select(
        "file_id", F.coalesce("out_degree", F.lit(0)).alias("out_degree")
    )
