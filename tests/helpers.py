"""Hand-written trees and sources for tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from codequarry.plans.templates import Node, Template, laid_out, leaf, n, t, text_of, widened  # noqa: F401

NODE_SCHEMA = (
    "file_id string, language string, pre int, last_desc int, parent int, depth int, child_ix int, type string, "
    "field string, named boolean, is_error boolean, is_missing boolean, start_idx int, end_idx int, start_row int, "
    "start_col int, end_row int, end_col int, leaf_text string"
)


def tree(language, *items, file_id="f"):
    """Node rows and the text of a hand-written tree."""
    template = Template(items)
    text = widened(text_of(template))
    laid = laid_out(template)
    rows = [(file_id, language, 0, len(laid), None, 0, 0, "program", None, True, False, False, 0, len(text), 0, 0,
             text.count("\n"), len(text) - text.rfind("\n") - 1, None)]
    for r in laid:
        rows.append((
            file_id, language, r.ix + 1, r.last_ix + 1, 0 if r.parent_ix is None else r.parent_ix + 1, r.depth,
            r.child_ix, r.node.type, r.node.field, r.node.named, r.node.is_error, r.node.is_missing, r.start[0],
            r.end[0], r.start[1], r.start[2], r.end[1], r.end[2], r.node.text if r.node.text is None else widened(r.node.text),
        ))
    return rows, text


def tables(spark, *trees):
    """``nodes`` and ``sources`` for (language, items) trees; files are named f0, f1, ..."""
    rows, texts = [], []
    for i, (language, items) in enumerate(trees):
        made, text = tree(language, *items, file_id=f"f{i}")
        rows += made
        texts.append((f"f{i}", f"src/f{i}", language, text))
    nodes = spark.createDataFrame(rows, NODE_SCHEMA)
    return nodes, spark.createDataFrame(texts, "file_id string, path string, language string, code string")


def collect(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def sources(spark, language, *codes):
    rows = [(f"f{i}", f"src/f{i}", language, code) for i, code in enumerate(codes)]
    return spark.createDataFrame(rows, "file_id string, path string, language string, code string")


def by_name(df, name):
    return df.filter(F.col("name") == name)
