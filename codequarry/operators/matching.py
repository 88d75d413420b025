"""Rule matching over a node table: a chain of equi-joins and one small rule join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codequarry.operators.lines import cut_whole
from codequarry.sources.rules import Rule, rules_table

_SPAN = ("start_row", "end_row", "start_idx", "end_idx")


def rule_candidates(nodes: DataFrame, rules: Sequence[Rule], bounded: bool = False) -> DataFrame:
    """One row per node that some rule captures, with its ancestor path: as many levels as the rules look at, each with the
    ancestor's number, type, field and span, and what guards its siblings show.

    Written once, this table answers every rule set that is part of ``rules``: the operators over rules take it in place of the nodes, and
    their matching is then one scan with a filter. Every join is keyed by (file, node), never by file alone, so
    one huge file is spread like any other data. Each level reads only node types that some rule names, and those filters
    reach the scan.

    ``bounded`` says that the nodes lie in partitions whose size does not grow (:func:`codequarry.plans.shared.by_file`): the
    ancestors of a partition are then hashed, and no level is sorted.
    """
    def near(df: DataFrame) -> DataFrame:
        return df.hint("shuffle_hash") if bounded else df

    names = nodes.filter(_name_filter(rules)).select(
        "file_id", "language", "parent", F.col("field").alias("n_field"), F.col("type").alias("n_type"),
        F.col("named").alias("n_named"), F.col("pre").alias("name_pre"), F.col("leaf_text").alias("name"),
        F.col("start_row").alias("name_row"), F.col("start_col").alias("name_col"),
        F.col("start_idx").alias("name_start"), F.col("end_idx").alias("name_end"),
    )
    found = names.join(near(_ancestor(nodes, 1, {r.t1 for r in rules}, rules)), ["file_id", "parent"])
    guards = sorted({(r.guard_field, t) for r in rules for t in r.guard_types})
    if guards:
        found = found.join(near(_guard_marks(nodes, guards, rules)), ["file_id", "parent"], "left")
    else:
        found = found.withColumn("marks", F.lit(None).cast("array<string>"))
    table, deepest = F.broadcast(rules_table(nodes.sparkSession, rules)), _deepest(rules)
    found = found.drop("parent").join(table, _level_fits(1), "left_semi")
    for level in range(2, deepest + 1):
        types = {t for r in rules if (t := (r.t2, r.t3)[level - 2])}
        above = _ancestor(nodes, level, types, rules).withColumnRenamed("parent", f"p{level - 1}")
        found = found.join(near(above), ["file_id", f"p{level - 1}"], "left")
    return found.drop(*[f"p{level}" for level in range(1, deepest + 1)])


def has_paths(nodes: DataFrame) -> bool:
    """Whether a table is one of rule candidates, not of plain nodes."""
    return "a1_type" in nodes.columns


def lacks_text() -> Column:
    """Candidates that are inner nodes: few, and the only ones whose text is cut."""
    return F.col("name").isNull() & F.col("name_start").isNotNull()


def with_candidate_names(candidates: DataFrame, sources: DataFrame) -> DataFrame:
    """Candidates whose captured node is no leaf with their text, cut once for all rule sets."""
    return cut_whole(candidates, sources, "name_start", "name_end", "name")


def match_rules(nodes: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule match: the captured node (``name_*``) and the construct's node (``kind_*``).

    ``nodes`` are plain nodes, whose ancestors are joined here, or :func:`rule_candidates` of these rules and more. The rule table
    is bounded by the caller's rule list and is broadcast.
    """
    deepest = _deepest(rules)
    if has_paths(nodes):
        if deepest > 1 and f"a{deepest}_type" not in nodes.columns:
            raise ValueError(f"the rules look {deepest} levels up, the candidates do not")
        found = nodes.filter(_languages(rules) & F.col("a1_type").isin(sorted({r.t1 for r in rules})))
    else:
        found = rule_candidates(nodes, rules)
    fits = reduce(Column.__and__, [_level_fits(level) for level in range(1, deepest + 1)])
    found = found.join(F.broadcast(rules_table(nodes.sparkSession, rules)), fits)

    def kind(what: str) -> Column:
        picked = F.when(F.col("kind_level") == 1, F.col(f"a1_{what}"))
        for level in range(2, deepest + 1):
            picked = picked.when(F.col("kind_level") == level, F.col(f"a{level}_{what}"))
        return picked.alias(f"kind_{what}")

    return found.select(
        "file_id", "language", "family", "pattern_ix", "kind", "name", "name_pre", "name_row", "name_col",
        "name_start", "name_end", kind("pre"), *[kind(c) for c in _SPAN],
    )


def with_names(matches: DataFrame, sources: DataFrame | None) -> DataFrame:
    """Read the text of captured nodes that are not leaves; without sources those names stay null."""
    if sources is None:
        return matches
    return cut_whole(matches, sources, "name_start", "name_end", "name")


def _deepest(rules: Sequence[Rule]) -> int:
    return max(r.kind_level for r in rules)


def _languages(rules: Sequence[Rule]) -> Column:
    return F.col("language").isin(sorted({r.lang for r in rules}))


def _name_filter(rules: Sequence[Rule]) -> Column:
    typed = [r for r in rules if r.name_type is not None]
    open_ = [r for r in rules if r.name_type is None]
    wanted = []
    if typed:
        wanted.append(F.col("type").isin(sorted({r.name_type for r in typed})) & _field_in(typed))
    if open_:
        wanted.append(F.col("named") & _languages(open_) & _field_in(open_))
    return _languages(rules) & F.col("parent").isNotNull() & reduce(Column.__or__, wanted)


def _field_in(rules: Sequence[Rule]) -> Column:
    fields = {r.name_field for r in rules}
    return F.lit(True) if None in fields else F.col("field").isin(sorted(fields))


def _ancestor(nodes: DataFrame, level: int, types: set[str], rules: Sequence[Rule]) -> DataFrame:
    """Nodes that may stand at a level, named by level; their number is the child's ``parent``."""
    return nodes.filter(F.col("type").isin(sorted(types)) & _languages(rules)).select(
        "file_id", F.col("pre").alias("parent"), F.col("pre").alias(f"a{level}_pre"),
        F.col("type").alias(f"a{level}_type"), F.col("field").alias(f"a{level}_field"),
        F.col("parent").alias(f"p{level}"), *[F.col(c).alias(f"a{level}_{c}") for c in _SPAN],
    )


def _guard_marks(nodes: DataFrame, guards: list[tuple[str, str]], rules: Sequence[Rule]) -> DataFrame:
    """Per parent, which guarded (field, type) pairs its children show: at most one entry per pair."""
    fields, types = zip(*guards)
    return (
        nodes.filter(F.col("type").isin(sorted(set(types))) & F.col("field").isin(sorted(set(fields))))
        .filter(_languages(rules) & F.col("parent").isNotNull())
        .groupBy("file_id", "parent")
        .agg(F.collect_set(F.concat_ws("=", "field", "type")).alias("marks"))
    )


def _any_or_equal(rule: str, seen: str) -> Column:
    return F.coalesce(F.col(rule).isNull() | (F.col(rule) == F.col(seen)), F.lit(False))


def _level_fits(level: int) -> Column:
    if level > 1:
        fits = _any_or_equal(f"t{level}", f"a{level}_type")
        return fits & _any_or_equal("f2", "a2_field") if level == 2 else fits
    wanted = F.transform("guard_types", lambda t: F.concat_ws("=", "guard_field", t))
    return (
        (F.col("language") == F.col("lang"))
        & (F.col("a1_type") == F.col("t1"))
        & F.coalesce(F.col("name_type").isNull() & F.col("n_named") | (F.col("name_type") == F.col("n_type")),
                     F.lit(False))
        & _any_or_equal("name_field", "n_field")
        & _any_or_equal("f1", "a1_field")
        & F.coalesce(F.col("guard_field").isNull() | F.arrays_overlap(wanted, "marks"), F.lit(False))
    )
