"""Views and lookups on a node table.

A node table has one row per syntax node: ``file_id, language, pre, last_desc, parent, depth, child_ix, type,
field, named, is_error, is_missing, start_idx, end_idx, start_row, start_col, end_row, end_col, leaf_text``.
``pre`` is the preorder number (the root has 0), and a node's descendants are the numbers
``pre < d <= last_desc``. Rows and columns are 0-based, offsets count code points. Unnamed nodes are leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codequarry.functions.intervals import containing
from codequarry.functions.limits import first_k
from codequarry.functions.text import CLIP_CHARS, LEAF_CHARS
from codequarry.operators.lines import cut_clipped

# Fixed values that interactive callers ask for: view depth, listed diagnostics, listed ancestors.
VIEW_DEPTH = 8
LISTED_DIAGNOSTICS = 20
LISTED_ANCESTORS = 33

_PART_BITS = 14
# Rows in a cell, as bits: 8, and 32 times as many.
_ROW_BITS, _ROW_STEP = 3, 5


def _node_error() -> Column:
    return F.when(F.col("is_error"), "syntax_error").when(F.col("is_missing"), "missing")


def tree_view(
    nodes: DataFrame, sources: DataFrame | None = None, max_depth: int | None = None, with_text: bool = False
) -> DataFrame:
    """Named nodes, all or down to ``max_depth`` (0 = root, at least 1), flat: nesting is ``parent`` and ``depth``.

    A node without named children is a leaf (with text on request); otherwise a node at the depth limit is
    ``truncated`` and carries its number of named children.
    """
    depth = (1 << 31) - 2 if max_depth is None else max(1, max_depth)
    kids = (
        nodes.filter(F.col("named") & F.col("parent").isNotNull() & (F.col("depth") <= depth + 1))
        .groupBy("file_id", F.col("parent").alias("pre"))
        .agg(F.count(F.lit(1)).alias("kids"))
    )
    seen = nodes.filter(F.col("named") & (F.col("depth") <= depth)).join(kids, ["file_id", "pre"], "left")
    leaf = F.col("kids").isNull()
    cut_off = ~leaf & (F.col("depth") >= depth)
    view = seen.withColumns({
        "error": _node_error(),
        "truncated": F.when(cut_off, F.lit(True)),
        "child_count": F.when(cut_off, F.col("kids")),
        "text": F.when(leaf, F.substring("leaf_text", 1, LEAF_CHARS)) if with_text else F.lit(None).cast("string"),
        "text_truncated": F.when(leaf & (F.col("end_idx") - F.col("start_idx") > LEAF_CHARS), F.lit(True))
        if with_text else F.lit(None).cast("boolean"),
        "is_leaf": leaf,
    })
    if with_text and sources is not None:
        view = cut_clipped(
            view, sources, "start_idx", "end_idx", LEAF_CHARS, "text", F.col("is_leaf") & F.col("leaf_text").isNull()
        )
    return view.select(
        "file_id", "pre", "parent", "depth", "type", "start_row", "start_col", "end_row", "end_col", "error",
        "truncated", "child_count", "text", "text_truncated",
    )


def tree_sexp_parts(nodes: DataFrame) -> DataFrame:
    """S-expression of each tree in ordered parts ``(file_id, part, text)`` of at most 16,384 nodes.

    An opening piece stands at ``pre``; the closing parentheses of all nodes that end with the same last
    descendant are counted by an aggregate and stand right after it. No window over a file is needed.
    Both come from one reading of the nodes, whose layout they keep: a union would lose it.
    """
    shown = F.col("named") | F.col("is_missing")
    label = F.when(F.col("field").isNotNull(), F.concat("field", F.lit(": "))).otherwise(F.lit(""))
    quoted = F.when(F.col("named"), F.col("type")).otherwise(F.concat(F.lit('"'), "type", F.lit('"')))
    head = F.when(F.col("is_missing"), F.concat(F.lit("(MISSING "), quoted)).otherwise(F.concat(F.lit("("), "type"))
    gap = F.when(F.col("parent").isNull(), "").otherwise(" ")
    ends = F.array(
        F.struct(F.col("pre").alias("at"), F.lit(0).alias("side"), F.concat(gap, label, head).alias("piece")),
        F.struct(F.col("last_desc").alias("at"), F.lit(1).alias("side"), F.lit(")").alias("piece")))
    pieces = (
        nodes.filter(shown).select("file_id", F.explode(ends).alias("e")).select("file_id", "e.*")
        .groupBy("file_id", "at", "side", "piece").agg(F.count(F.lit(1)).alias("n"))
        .select("file_id", "at", "side", F.repeat(F.col("piece"), F.col("n").cast("int")).alias("piece"))
    )
    return (
        pieces
        .groupBy("file_id", F.shiftright("at", _PART_BITS).alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct("at", "side", "piece"))).alias("pieces"))
        .select("file_id", "part", F.array_join(F.col("pieces.piece"), "").alias("text"))
    )


def tree_sexp(nodes: DataFrame) -> DataFrame:
    """One S-expression string per file. Parts are built in parallel; only finished text meets at the end."""
    parts = tree_sexp_parts(nodes)
    return parts.groupBy("file_id").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("part", "text")))["text"], "").alias("sexp")
    )


def diagnostics(nodes: DataFrame) -> DataFrame:
    """All error and missing nodes, unnamed ones too; ``pre`` is their order."""
    return nodes.filter(F.col("is_error") | F.col("is_missing")).select(
        "file_id", "pre", "type", F.when(F.col("is_error"), "error").otherwise("missing").alias("kind"),
        "start_row", "start_col", "end_row", "end_col",
    )


def diagnostic_summary(nodes: DataFrame, listed: int | None = None) -> DataFrame:
    """Per file: ``has_errors``, ``error_count``, all or the first ``listed`` diagnostics, ``errors_truncated``."""
    bad = F.col("is_error") | F.col("is_missing")
    counts = nodes.groupBy("file_id").agg(F.count_if(bad).alias("error_count"))
    entry = F.struct("rank", "type", "kind", "start_row", "start_col", "end_row", "end_col")
    first = (
        _ranked(diagnostics(nodes), ["file_id"], F.col("pre"), listed)
        .groupBy("file_id").agg(F.sort_array(F.collect_list(entry)).alias("errors"))
    )
    return counts.join(first, "file_id", "left").select(
        "file_id", (F.col("error_count") > 0).alias("has_errors"), "error_count", "errors",
        (F.lit(False) if listed is None else F.col("error_count") > listed).alias("errors_truncated"),
    )


def ancestors(nodes: DataFrame, keys: DataFrame, listed: int | None = None) -> DataFrame:
    """Ancestors of the nodes ``keys (file_id, pre)``, nearest first (``rank`` 1 = parent); all, or the ``listed`` nearest."""
    above = nodes.filter(F.col("last_desc") > F.col("pre")).select(
        "file_id", F.col("pre").alias("ancestor_pre"), F.col("type").alias("ancestor_type"),
        F.col("start_row").alias("ancestor_start_row"), F.col("end_row").alias("ancestor_end_row"),
        (F.col("pre") + 1).alias("_low"), F.col("last_desc").alias("_high"),
    )
    held = containing(keys.select("file_id", "pre").distinct(), above, "pre", "_low", "_high").drop("_low", "_high")
    return _ranked(held, ["file_id", "pre"], F.desc("ancestor_pre"), listed)


def _ranked(rows: DataFrame, keys: list[str], order: Column, listed: int | None) -> DataFrame:
    if listed is not None:
        return first_k(rows, keys, [order], listed)
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))


def clean_positions(positions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split ``(file_id, row, col)`` into usable positions (floored, not negative) and error rows."""
    def finite(c: str) -> Column:
        return F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))

    given = positions.withColumns({c: F.col(c).cast("double") for c in ("row", "col")})
    good = finite("row") & finite("col")
    limit = F.lit(float((1 << 31) - 1))
    ok = given.filter(good).withColumns(
        {c: F.least(F.greatest(F.lit(0.0), F.floor(c).cast("double")), limit).cast("bigint") for c in ("row", "col")}
    )
    return ok, given.filter(~good).withColumn("error", F.lit("row and col must be finite numbers"))


def _spanning(nodes: DataFrame, points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``file_id, row, col, pre`` of every node around every point (ends are exclusive): nodes within one row, and the others.

    Nodes within one row are looked up by their columns in that row, the others by their rows; so neither one long line
    nor one long file is a single group. Two tables, because a union would lose the layout by file.
    """
    place = [F.col(c).cast("bigint").alias(f"_{c}") for c in ("start_row", "start_col", "end_row", "end_col")]
    spans = nodes.select("file_id", "pre", *place)
    short = spans.filter("_start_row = _end_row").select(
        "file_id", F.col("_start_row").alias("row"), "pre", F.col("_start_col").alias("_low"), (F.col("_end_col") - 1).alias("_high"))
    in_row = containing(points, short, "col", "_low", "_high", keys=("file_id", "row"))
    tall = spans.filter("_start_row < _end_row")
    over_rows = containing(points, tall, "row", "_start_row", "_end_row", first_bits=_ROW_BITS, step_bits=_ROW_STEP).filter(
        "(row > _start_row OR col >= _start_col) AND (row < _end_row OR col < _end_col)")
    return in_row, over_rows


def node_at(
    nodes: DataFrame, positions: DataFrame, sources: DataFrame | None = None, named: bool = True
) -> DataFrame:
    """Smallest node spanning each cleaned position (its end is exclusive); all null for an unknown file.

    The containing nodes are nested, so the one with the largest ``pre`` is the deepest; only these numbers are
    compared, and the details of the winner are joined at the end. A position outside every node gets the root.
    """
    detail = ("type", "named", "start_row", "start_col", "end_row", "end_col", "start_idx", "end_idx", "leaf_text")
    if named:
        nodes = nodes.filter("named")
    asked = positions.select("file_id", F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col")).distinct()
    point = ["file_id", "row", "col"]
    in_row, over_rows = [
        held.groupBy(*point).agg(F.max("pre").alias(f"_pre{i}")) for i, held in enumerate(_spanning(nodes, asked))]
    details = nodes.select(F.col("file_id").alias("_file"), "pre", *detail)
    found = (
        asked.join(in_row, point, "left").join(over_rows, point, "left")
        .withColumn("_pre", F.coalesce(F.greatest("_pre0", "_pre1"), F.lit(0)))
        .join(details, (F.col("file_id") == F.col("_file")) & (F.col("_pre") == F.col("pre")), "left")
        .select("file_id", "row", "col", "pre", *detail)
        .withColumn("text", F.substring("leaf_text", 1, CLIP_CHARS))
    )
    if sources is not None:
        todo = F.col("leaf_text").isNull() & F.col("pre").isNotNull()
        found = cut_clipped(found, sources, "start_idx", "end_idx", CLIP_CHARS, "text", todo)
    return found.select(
        "file_id", "row", "col", "pre", "type", "start_row", "start_col", "end_row", "end_col", "text",
        F.col("named").alias("is_named"),
    )


def node_at_with_ancestors(
    nodes: DataFrame, positions: DataFrame, sources: DataFrame | None = None, named: bool = True, listed: int | None = None
) -> DataFrame:
    """:func:`node_at` with ``ancestors``: the nodes above each found node, nearest first (empty at a root, null for an unknown file).

    Ancestors are looked up once for each found node, however many positions hit it. All of them, or the ``listed``
    nearest; a list is as long as the node is deep.
    """
    found = node_at(nodes, positions, sources, named)
    keys = found.filter(F.col("pre").isNotNull()).select("file_id", "pre").distinct()
    entry = F.struct("rank", F.col("ancestor_pre").alias("pre"), F.col("ancestor_type").alias("type"),
                     F.col("ancestor_start_row").alias("start_row"), F.col("ancestor_end_row").alias("end_row"))
    above = ancestors(nodes, keys, listed).groupBy("file_id", "pre").agg(F.sort_array(F.collect_list(entry)).alias("ancestors"))
    empty = F.when(F.col("pre").isNotNull(), F.array().cast(above.schema["ancestors"].dataType))
    return found.join(above, ["file_id", "pre"], "left").withColumn("ancestors", F.coalesce("ancestors", empty)).select(
        *found.columns, "ancestors")
