"""Node tables for markup pages, built from tokens and tag pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codequarry.operators.tokens import page_pairs, page_tokens

_PLACE = ("start_idx", "end_idx", "row", "col")


def _nested(pairs: DataFrame) -> DataFrame:
    """Tag pairs that do not cross each other: pairs of one common bracket structure over all tags."""
    ends = pairs.filter("status = 'paired'").select(
        "file_id",
        F.explode(F.array(
            F.struct(F.col("pos").alias("at"), F.lit(1).alias("turn"), F.col("close_pos").alias("mate")),
            F.struct(F.col("close_pos").alias("at"), F.lit(-1).alias("turn"), F.col("pos").alias("mate")),
        )).alias("e"),
    ).select("file_id", "e.*")
    running = F.sum("turn").over(Window.partitionBy("file_id").orderBy("at"))
    level = running + F.when(F.col("turn") == 1, 0).otherwise(1)
    by_level = Window.partitionBy("file_id", "level").orderBy("at")
    return (
        ends.withColumn("level", level)
        .withColumns({"next_at": F.lead("at").over(by_level)})
        .filter((F.col("turn") == 1) & (F.col("next_at") == F.col("mate")))
        .select("file_id", F.col("at").alias("pos"), F.col("mate").alias("close_pos"))
    )


def element_nodes(pages: DataFrame) -> DataFrame:
    """Node rows of ``pages (file_id, html)``: a document root, elements with their tags, text and leaves.

    A tag without a partner is a leaf marked missing (never closed) or error (closes nothing). Pairs that
    cross another pair count as unpaired, so that intervals always nest. Blank text makes no node.
    """
    toks = page_tokens(pages)
    pairs = _nested(page_pairs(toks))
    marks = pairs.select(
        "file_id",
        F.explode(F.array(
            F.struct("pos", F.lit(1).alias("turn"), F.col("close_pos").alias("mate")),
            F.struct(F.col("close_pos").alias("pos"), F.lit(-1).alias("turn"), F.col("pos").alias("mate")),
        )).alias("m"),
    ).select("file_id", "m.*")
    kept = toks.filter((F.col("kind") != "text") | F.col("text").rlike(r"[^ \t\r\n\f]"))
    marked = kept.join(marks, ["file_id", "pos"], "left")

    # Places where a token ends: the row and column of the next character.
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    tail = F.length(F.substring_index("text", "\n", -1))
    marked = marked.withColumns({
        "end_row": F.col("row") + breaks,
        "end_col": F.when(breaks > 0, tail).otherwise(F.col("col") + F.length("text")),
    })

    # An element and its opening tag are two nodes: every opening that has a partner counts twice.
    by_file = Window.partitionBy("file_id").orderBy("pos")
    opens = F.coalesce(F.col("turn") == 1, F.lit(False))
    closes = F.coalesce(F.col("turn") == -1, F.lit(False))
    numbered = marked.withColumns({
        "last_pre": F.sum(F.when(opens, 2).otherwise(1)).over(by_file).cast("int"),
        # Depth of the token: how many elements are open around it, its own element included.
        "around": F.sum(F.when(opens, 1).when(closes, -1).otherwise(0)).over(by_file).cast("int")
        + F.when(closes, 1).otherwise(0),
    })

    # Closing tags bring their place to the element; both ends lie at the same depth, next to each other.
    end = F.struct("last_pre", "end_idx", "end_row", "end_col")
    ends_only = Window.partitionBy("file_id", "around", F.col("turn").isNotNull()).orderBy("pos")
    placed = numbered.withColumn("closed", F.when(opens, F.lead(end).over(ends_only)))

    kind = F.col("kind")
    leaf_type = (
        F.when(opens | (kind == "open"), "start_tag").when(closes, "end_tag").when(kind == "close", "erroneous_end_tag")
        .when(kind == "void", "element").when(kind == "self_closing", "self_closing_tag").otherwise(kind)
    )

    def node(**over: Column) -> Column:
        fields = {
            "pre": F.col("last_pre"), "last_desc": F.col("last_pre"), "depth": F.col("around") + 1, "type": leaf_type,
            "is_error": (kind == "close") & ~closes, "is_missing": (kind == "open") & ~opens,
            "start_idx": F.col("start_idx"), "end_idx": F.col("end_idx"), "start_row": F.col("row"),
            "start_col": F.col("col"), "end_row": F.col("end_row"), "end_col": F.col("end_col"), "leaf_text": F.col("text"),
            **over,
        }
        return F.struct(*[v.cast(_TYPES[k]).alias(k) for k, v in fields.items()])

    closed = F.col("closed")
    element = node(
        pre=F.col("last_pre") - 1, last_desc=closed["last_pre"], depth=F.col("around"), type=F.lit("element"),
        end_idx=closed["end_idx"], end_row=closed["end_row"], end_col=closed["end_col"], leaf_text=F.lit(None),
    )
    both = F.when(opens, F.array(element, node())).otherwise(F.array(node()))
    nodes = _with_parents(placed.select("file_id", F.explode(both).alias("n")).select("file_id", "n.*"))
    roots = _roots(pages, nodes)
    siblings = Window.partitionBy("file_id", "parent").orderBy("pre")
    numbers = (F.row_number().over(siblings) - 1).cast("int")
    return nodes.withColumn("child_ix", numbers).unionByName(roots).withColumns({
        "language": F.lit("html"), "field": F.lit(None).cast("string"), "named": F.lit(True),
    }).select("file_id", "language", "pre", "last_desc", "parent", "depth", "child_ix", "type", "field", "named",
              "is_error", "is_missing", "start_idx", "end_idx", "start_row", "start_col", "end_row", "end_col",
              "leaf_text")


_TYPES = {
    "pre": "int", "last_desc": "int", "depth": "int", "type": "string", "is_error": "boolean",
    "is_missing": "boolean", "start_idx": "int", "end_idx": "int", "start_row": "int", "start_col": "int",
    "end_row": "int", "end_col": "int", "leaf_text": "string",
}


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Add ``parent``: the last element one depth further out that starts before the node."""
    is_element = (F.col("type") == "element") & F.col("leaf_text").isNull()
    # An element sits at its own depth as a possible parent, and one further out as a child.
    seats = F.when(is_element, F.array(F.col("depth"), F.col("depth") - 1)).otherwise(F.array(F.col("depth") - 1))
    offered = F.when(is_element & (F.col("seat") == F.col("depth")), F.col("pre"))
    before = Window.partitionBy("file_id", "seat").orderBy("pre").rowsBetween(Window.unboundedPreceding, -1)
    return (
        nodes.withColumn("seat", F.explode(seats))
        .withColumn("parent", F.coalesce(F.last(offered, ignorenulls=True).over(before), F.lit(0)))
        .filter(F.col("seat") == F.col("depth") - 1)
        .drop("seat")
    )


def _roots(pages: DataFrame, nodes: DataFrame) -> DataFrame:
    last = nodes.groupBy("file_id").agg(F.max("last_desc").alias("last_desc"))
    text = F.col("html")
    tail = F.length(F.substring_index(text, "\n", -1))
    return pages.join(last, "file_id", "left").select(
        "file_id", F.lit(0).alias("pre"), F.coalesce("last_desc", F.lit(0)).alias("last_desc"),
        F.lit(None).cast("int").alias("parent"), F.lit(0).alias("depth"), F.lit("document").alias("type"),
        F.lit(False).alias("is_error"), F.lit(False).alias("is_missing"), F.lit(0).alias("start_idx"),
        F.length(text).alias("end_idx"), F.lit(0).alias("start_row"), F.lit(0).alias("start_col"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))).alias("end_row"), tail.alias("end_col"),
        F.lit(None).cast("string").alias("leaf_text"), F.lit(0).alias("child_ix"),
    )
