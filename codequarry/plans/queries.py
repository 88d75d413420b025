"""Registered queries: each runs one operator over whole tables and returns plain columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codequarry.operators import calls as C
from codequarry.operators import definitions as D
from codequarry.operators import imports as I
from codequarry.operators import lexical as X
from codequarry.operators import lines as L
from codequarry.operators import markup as M
from codequarry.operators import matching as Ma
from codequarry.operators import nodes as N
from codequarry.operators import outline as O
from codequarry.operators import patterns as P
from codequarry.operators import references as R
from codequarry.operators import report as S
from codequarry.operators import scan as Sc
from codequarry.operators import tokens as T
from codequarry.sources import files as Fi
from codequarry.sources.languages import LANGUAGE_OF, language_capabilities
from codequarry.sources.rules import RULES, rule_set
from codequarry.plans.corpus import FILE_STEP, PARTS_PER_FILE, corpus, file_buckets, file_table, read
from codequarry.plans.shared import shared_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured nodes of all rules with their ancestor paths and names: stored once, read by definitions, calls and imports.

    Names of inner nodes are stored beside them, so that the leaves, the bulk, are written once.
    """
    paths = file_table(spark, sf_dir, "rule_candidates", lambda s, d: Ma.rule_candidates(corpus(s, d).nodes, RULES, bounded=True))
    inner = file_table(spark, sf_dir, "inner_candidates", lambda s, d: Ma.with_candidate_names(
        paths.filter(Ma.lacks_text()), corpus(s, d).sources))
    return paths.filter(~Ma.lacks_text()).unionByName(inner)


def _defs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.definitions(candidates(spark, sf_dir))


def stored_defs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The definitions as a stored table: what reports, outlines and text cuts start from."""
    return file_table(spark, sf_dir, "definitions", _defs)


def _text(column: str):
    return F.coalesce(F.col(column), F.lit("")).alias(column)


# ---------------------------------------------------------------- definitions and reports
@query
def definitions_by_kind(spark, sf_dir):
    return _defs(spark, sf_dir).groupBy("language", "kind").agg(F.count(F.lit(1)).alias("n_definitions"))


@query
def definitions_dedupe(spark, sf_dir):
    # The place in the file checks the order; a corpus file holds at most 256 blocks.
    place = F.row_number().over(Window.partitionBy("file_id").orderBy(*D.match_order())).alias("place")
    return _defs(spark, sf_dir).select("file_id", "language", "kind", "name", "start_line", "end_line", place)


@query
def count_by_kind(spark, sf_dir):
    return D.count_by_kind(stored_defs(spark, sf_dir))


@query
def file_results(spark, sf_dir):
    files = corpus(spark, sf_dir).files.select("file_id")
    listed = F.transform("definitions", lambda d: F.concat(
        d["kind"], F.lit(" "), d["name"], F.lit(" "), d["start_line"].cast("string"), F.lit("-"),
        d["end_line"].cast("string")))
    kinds = F.transform(F.map_entries("by_kind"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return D.file_results(stored_defs(spark, sf_dir), files).select(
        "file_id", "part", "total", F.array_join(kinds, ",").alias("kinds"),
        F.coalesce(F.array_join(listed, ";"), F.lit("")).alias("listed"),
    )


@query
def by_language(spark, sf_dir):
    return S.by_language(corpus(spark, sf_dir).files, stored_defs(spark, sf_dir))


@query
def by_kind(spark, sf_dir):
    return S.by_kind(stored_defs(spark, sf_dir))


@query
def scan_rollup(spark, sf_dir):
    star = [F.coalesce(c, F.lit("*")).alias(c) for c in ("language", "kind")]
    return S.rollup(stored_defs(spark, sf_dir)).select(*star, "n_definitions", "level")


@query
def file_reports(spark, sf_dir):
    data = corpus(spark, sf_dir)
    return _report_rows(S.file_reports(data.files, stored_defs(spark, sf_dir), data.sources, S.REPORTED_FILES, 20))


@query
def file_reports_all(spark, sf_dir):
    data = corpus(spark, sf_dir)
    return _report_rows(S.file_reports(data.files, stored_defs(spark, sf_dir), data.sources))


def _report_rows(reports):
    rows = reports.select("path", "language", "total", F.explode_outer("definitions").alias("d"))
    return rows.select("path", "language", "total", *[
        F.coalesce(f"d.{c}", F.lit("" if c != "line" else 0)).alias(c) for c in ("kind", "name", "line", "signature")])


# ---------------------------------------------------------------- calls
def _calls(spark, sf_dir):
    return C.calls(candidates(spark, sf_dir))


@query
def calls(spark, sf_dir):
    return _calls(spark, sf_dir).select("file_id", "language", "name", "line")


@query
def listed_calls(spark, sf_dir):
    return C.listed_calls(_calls(spark, sf_dir), 50).select(
        "file_id", "name", "line", F.col("rank").alias("place"), "total")


@query
def listed_calls_all(spark, sf_dir):
    return C.listed_calls(_calls(spark, sf_dir)).select("file_id", "name", "line", F.col("rank").alias("place"), "total")


@query
def top_callees(spark, sf_dir):
    return C.top_callees(_calls(spark, sf_dir)).withColumnRenamed("rank", "place")


@query
def corpus_top_callees(spark, sf_dir):
    return C.corpus_top_callees(_calls(spark, sf_dir))


@query
def language_top_callees(spark, sf_dir):
    return C.corpus_top_callees(_calls(spark, sf_dir), 10, ["language"]).withColumnRenamed("rank", "place")


# ---------------------------------------------------------------- imports
def _imports(spark, sf_dir):
    return I.imports(candidates(spark, sf_dir), corpus(spark, sf_dir).sources)


def _edges(spark, sf_dir):
    """Edges need no statement text."""
    return I.import_edges(I.imports(candidates(spark, sf_dir), None))


@query
def imports(spark, sf_dir):
    return _imports(spark, sf_dir).select("file_id", "language", "module", "line", "raw")


@query
def import_edges(spark, sf_dir):
    return _edges(spark, sf_dir)


@query
def module_degrees(spark, sf_dir):
    return I.module_degrees(_edges(spark, sf_dir))


@query
def file_degrees(spark, sf_dir):
    return I.file_degrees(_edges(spark, sf_dir), corpus(spark, sf_dir).files)


# ---------------------------------------------------------------- references
def callee_names(spark, sf_dir):
    size = F.lpad(F.col("p_size").cast("string"), 2, "0")
    return read(spark, sf_dir, "part").select(F.concat(F.lit("price_"), size).alias("name")).distinct()


def part_names(spark, sf_dir):
    key = F.lpad(F.col("p_partkey").cast("string"), 12, "0")
    return read(spark, sf_dir, "part").select(F.concat(F.lit("n_"), key).alias("name"))


@query
def references(spark, sf_dir):
    data = corpus(spark, sf_dir)
    names = part_names(spark, sf_dir).unionByName(callee_names(spark, sf_dir))
    return R.references(data.nodes, names, data.sources).select("file_id", "name", "line", "col", "context")


@query
def references_limited(spark, sf_dir):
    found = R.references(corpus(spark, sf_dir).nodes, callee_names(spark, sf_dir))
    return R.limited(found, 3).select("file_id", "name", "line", "total", "truncated")


# Letters and the same letters as base and combining mark.
DECOMPOSED = {"\u00e9": "e\u0301", "\u00e8": "e\u0300", "\u00ea": "e\u0302", "\u00e7": "c\u0327", "\u00f1": "n\u0303",
              "\u00fc": "u\u0308", "\u00f6": "o\u0308", "\u00e4": "a\u0308", "\u00ed": "i\u0301", "\u00f3": "o\u0301"}


@query
def references_composed(spark, sf_dir):
    """Words of all documents as leaves, every other one with decomposed letters, against the non-ASCII words as names."""
    words = read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file_id"), F.posexplode(F.regexp_extract_all("text", F.lit(r"[^ \t\r\n]+"), 0)).alias("pos", "word"))
    apart = F.col("word")
    for letter, marks in DECOMPOSED.items():
        apart = F.replace(apart, F.lit(letter), F.lit(marks))
    nodes = words.select(
        "file_id", (F.col("pos") + 1).alias("pre"), (F.col("pos") + 1).alias("last_desc"), F.lit("identifier").alias("type"),
        F.lit(0).alias("start_row"), F.col("pos").alias("start_col"),
        F.when(F.col("pos") % 2 == 0, apart).otherwise(F.col("word")).alias("leaf_text"))
    names = words.filter(F.col("word").rlike(r"[^\x00-\x7F]")).select(F.col("word").alias("name")).distinct()
    return R.references(nodes, names).select("file_id", "name", "line", "col")


# ---------------------------------------------------------------- lookups and views
def positions(spark, sf_dir):
    """One asked position per order line; fractions and negative columns included."""
    return read(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") * FILE_STEP + F.floor(F.col("l_partkey") / PARTS_PER_FILE)).alias("file_id"),
        (F.col("l_partkey") % PARTS_PER_FILE + F.col("l_discount")).alias("row"),
        (F.col("l_quantity") / 2 - 3).alias("col"),
    )


def _asked_positions(spark, sf_dir):
    """Positions that are finite numbers, stored by file like the nodes: shuffled once, however often they meet them."""
    return file_table(spark, sf_dir, "asked_positions", lambda s, d: N.clean_positions(positions(s, d))[0].repartition(
        file_buckets(s, d), "file_id"))


@query
def node_at(spark, sf_dir):
    data = corpus(spark, sf_dir)
    found = N.node_at(data.nodes, _asked_positions(spark, sf_dir), data.sources)
    return found.select("file_id", "row", "col", _text("type"), F.coalesce("start_row", F.lit(-1)).alias("start_row"),
                        F.coalesce("end_col", F.lit(-1)).alias("end_col"), _text("text"))


@query
def position_errors(spark, sf_dir):
    """Positions that are no finite numbers."""
    asked = positions(spark, sf_dir).withColumns({
        "col": F.when(F.floor("row") % 3 == 1, F.lit(float("nan"))).when(F.floor("row") % 3 == 2, F.lit(float("inf"))).otherwise(F.col("col"))})
    return N.clean_positions(asked)[1].groupBy("file_id", "error").agg(F.count(F.lit(1)).alias("n_positions"))


@query
def node_at_ancestors(spark, sf_dir):
    """The node at each position together with the types above it, nearest first."""
    found = N.node_at_with_ancestors(corpus(spark, sf_dir).nodes, _asked_positions(spark, sf_dir))
    return found.select("file_id", "row", "col", _text("type"), F.array_join("ancestors.type", " ").alias("above"))


@query
def ancestors(spark, sf_dir):
    nodes = corpus(spark, sf_dir).nodes
    keys = nodes.filter(F.col("leaf_text").like("price_%")).select("file_id", "pre")
    return N.ancestors(nodes, keys, N.LISTED_ANCESTORS)


@query
def ancestors_all(spark, sf_dir):
    nodes = corpus(spark, sf_dir).nodes
    return N.ancestors(nodes, nodes.filter(F.col("leaf_text").like("price_%")).select("file_id", "pre"))


@query
def tree_view(spark, sf_dir):
    data = corpus(spark, sf_dir)
    return N.tree_view(data.nodes, data.sources, max_depth=3, with_text=True).select(
        "file_id", "pre", "depth", "type", "start_row", "start_col", "end_row", "end_col", _text("error"),
        F.coalesce("truncated", F.lit(False)).alias("truncated"), F.coalesce("child_count", F.lit(0)).alias("child_count"),
        _text("text"), F.coalesce("text_truncated", F.lit(False)).alias("text_truncated"))


@query
def tree_view_all(spark, sf_dir):
    data = corpus(spark, sf_dir)
    return N.tree_view(data.nodes, data.sources, with_text=True).select(
        "file_id", "pre", "depth", "type", _text("error"), F.coalesce("truncated", F.lit(False)).alias("truncated"), _text("text"))


@query
def tree_sexp(spark, sf_dir):
    return N.tree_sexp(corpus(spark, sf_dir).nodes)


@query
def diagnostics(spark, sf_dir):
    return N.diagnostics(corpus(spark, sf_dir).nodes)


@query
def diagnostic_summary(spark, sf_dir):
    return N.diagnostic_summary(corpus(spark, sf_dir).nodes, N.LISTED_DIAGNOSTICS).select(
        "file_id", "has_errors", "error_count", F.coalesce(F.size("errors"), F.lit(0)).alias("listed"), "errors_truncated")


@query
def diagnostic_summary_all(spark, sf_dir):
    return N.diagnostic_summary(corpus(spark, sf_dir).nodes).select(
        "file_id", "has_errors", "error_count", F.coalesce(F.size("errors"), F.lit(0)).alias("listed"), "errors_truncated")


# ---------------------------------------------------------------- outline and text cuts
@query
def outline(spark, sf_dir):
    return O.outline_levels(stored_defs(spark, sf_dir)).select("file_id", "start_line", "name", "kind", "level")


@query
def outline_text(spark, sf_dir):
    defs = stored_defs(spark, sf_dir)
    return O.outline_text(O.outline_levels(defs), corpus(spark, sf_dir).files, defs).select("file_id", "part", "outline")


_DEF = ("file_id", "name", "kind", "start_line")


@query
def signature(spark, sf_dir):
    return L.signature(stored_defs(spark, sf_dir), corpus(spark, sf_dir).sources).select(*_DEF, "signature")


@query
def body(spark, sf_dir):
    return L.with_body(stored_defs(spark, sf_dir), corpus(spark, sf_dir).sources, 1, 2).select(*_DEF, "body")


@query
def context(spark, sf_dir):
    return L.with_context(stored_defs(spark, sf_dir), corpus(spark, sf_dir).sources, 2, 0).select(*_DEF, "context")


# ---------------------------------------------------------------- structural queries
def _kept_matches(spark, sf_dir, query):
    """Stores the matches of one query, by file like the nodes they are found in."""
    def keep(name, rows):
        return file_table(spark, sf_dir, f"{query}_{name}", lambda s, d: rows.repartition(file_buckets(s, d), "file_id"))
    return keep


@query
def structural_query(spark, sf_dir):
    pattern = (
        P.node("call", "call_expression")
        .field("function", P.node("identifier").capture("callee"))
        .field("arguments", P.node().child(P.node("number")))
    )
    matches = P.match(corpus(spark, sf_dir).nodes, [pattern])
    return P.capture_rows(matches).select("file_id", "match_pre", "capture_pre", "name", "type", "text")


@query
def structural_query_limited(spark, sf_dir):
    pattern = P.node("call", "call_expression", "method_invocation").capture("call")
    return P.match(corpus(spark, sf_dir).nodes, [pattern], limit=5).select(
        "file_id", "match_pre", "total", "truncated", "rank")


@query
def structural_query_absent(spark, sf_dir):
    pattern = (
        P.node("struct_item", "enum_item", "class_declaration", "type_alias_declaration")
        .field("name", P.node().capture("name")).without("body")
    )
    return P.capture_rows(P.match(corpus(spark, sf_dir).nodes, [pattern])).select("file_id", "match_pre", "text")


@query
def structural_query_siblings(spark, sf_dir):
    pattern = (
        P.node().child(P.node("type_identifier", "primitive_type").capture("left"))
        .then(P.node("identifier", "type_identifier").capture("right"))
    )
    return P.match(corpus(spark, sf_dir).nodes, [pattern]).select(
        "file_id", "match_pre", F.col("captures")[0]["text"].alias("left_text"),
        F.col("captures")[1]["text"].alias("right_text"))


@query
def structural_query_text(spark, sf_dir):
    patterns = [
        P.node("identifier", "property_identifier").text_matches("^price_[0-3]").capture("cheap"),
        P.node("call").field("function", P.node().text_is("price_01", "price_02").capture("named")),
        P.node("attribute").child(P.node("identifier").text_is_not("self").capture("member")),
    ]
    matches = P.match(corpus(spark, sf_dir).nodes, patterns, allow_regex=True)
    return P.capture_rows(matches).select("file_id", "pattern_index", "match_pre", "capture_pre", "name", "text")


@query
def structural_query_quantifiers(spark, sf_dir):
    """Argument lists with all their numbers, and classes with their body if they have one."""
    patterns = [
        P.node("argument_list", "arguments").any_number(P.node("number", "int_literal", "integer").capture("number")),
        P.node("class_declaration", "class_specifier", "class_definition", "class")
        .field("name", P.node().first().capture("name")).optional(P.node().last().capture("body"), field="body"),
    ]
    matches = P.match(corpus(spark, sf_dir).nodes, patterns)
    return matches.select("file_id", "pattern_index", "match_pre", F.size("captures").alias("n_captures"))


@query
def structural_query_captures(spark, sf_dir):
    """Text of inner nodes, clipped, with their places."""
    data = corpus(spark, sf_dir)
    pattern = P.node("class_body", "declaration_list", "compound_statement", "block").capture("body")
    captures = P.capture_rows(P.match(data.nodes, [pattern], data.sources))
    return captures.select("file_id", "capture_pre", "type", "start_row", "start_col", "end_row", "end_col", "text")


@query
def structural_query_alternatives(spark, sf_dir):
    """The calls of all languages as one pattern with one capture name: plain, attribute, member, field and scoped callees."""
    data = corpus(spark, sf_dir)
    callee = P.either(
        P.node("identifier", "name", "qualified_name").capture("callee"),
        P.node("attribute").field("attribute", P.node("identifier").capture("callee")),
        P.node("member_expression").field("property", P.node("property_identifier").capture("callee")),
        P.node("selector_expression", "field_expression").field("field", P.node("field_identifier").capture("callee")),
        P.node("scoped_identifier", "qualified_identifier").field("name", P.node("identifier").capture("callee")),
    )
    call = P.either(
        P.node("call", "call_expression", "function_call_expression").field("function", callee),
        P.node("call").field("method", P.node("identifier").capture("callee")),
        P.node("method_invocation").field("name", P.node("identifier").capture("callee")),
        P.node("member_call_expression", "scoped_call_expression").field("name", P.node("name").capture("callee")),
        P.node("command").field("name", P.node("command_name").capture("callee")),
    )
    found = P.capture_rows(P.match(data.nodes, [call], data.sources, keep=_kept_matches(spark, sf_dir, "alternatives")))
    return found.select("file_id", "pattern_index", F.substring_index("text", "\\", -1).alias("callee"),
                        (F.col("start_row") + 1).alias("line"))


@query
def structural_query_compared(spark, sf_dir):
    """Functions that pass on their parameters as they are, those that do not, and neighbouring names that differ."""
    data = corpus(spark, sf_dir)
    call = P.node("call", "call_expression").field("arguments", P.node().capture("right"))
    passing = P.node().field("parameters", P.node().capture("left")).field("body", P.node().child(P.node().child(call)))
    name = P.node("identifier", "type_identifier", "property_identifier")
    patterns = [
        passing.same_text("left", "right"), passing.other_text("left", "right"),
        P.node().child(name.capture("left")).then(name.capture("right")).other_text("left", "right"),
    ]
    return P.match(data.nodes, patterns, data.sources, keep=_kept_matches(spark, sf_dir, "compared")).select(
        "file_id", "pattern_index", "match_pre", F.col("captures")[0]["pre"].alias("left_pre"),
        F.col("captures")[1]["pre"].alias("right_pre"), F.col("captures")[1]["text"].alias("text"))


@query
def user_rules(spark, sf_dir):
    """A rule set of the user's own: parameters and decorated functions of Python."""
    rules = rule_set("definition", [
        ("python", "module", "identifier", None, "parameters"),
        ("python", "function", "identifier", "name", "function_definition", None, "decorated_definition"),
        ("python", "type", "identifier", None, "decorator"),
    ])
    return D.definitions(corpus(spark, sf_dir).nodes, rules=rules).select("file_id", "kind", "name", "start_line", "end_line")


# ---------------------------------------------------------------- pages
def _pages(spark, sf_dir):
    return read(spark, sf_dir, "pages").select(F.col("page_id").alias("file_id"), "html")


def page_nodes(spark, sf_dir):
    return shared_table(spark, sf_dir, "page_nodes", lambda s, d: M.element_nodes(_pages(s, d)))


@query
def page_tokens(spark, sf_dir):
    return T.page_tokens(_pages(spark, sf_dir)).select(
        "file_id", "pos", "kind", "tag", "text", "start_idx", "row", "col")


@query
def page_pairs(spark, sf_dir):
    pairs = T.page_pairs(T.page_tokens(_pages(spark, sf_dir)))
    return pairs.select("file_id", "pair_kind", "pos", "status", F.coalesce("close_pos", F.lit(-1)).alias("close_pos"), "depth")


@query
def element_nodes(spark, sf_dir):
    return M.element_nodes(_pages(spark, sf_dir)).select(
        "file_id", "pre", "last_desc", F.coalesce("parent", F.lit(-1)).alias("parent"), "depth", "child_ix", "type",
        "is_error", "is_missing", "start_idx", "end_idx", "start_row", "start_col", "end_row", "end_col", _text("leaf_text"))


@query
def page_tree_view(spark, sf_dir):
    return N.tree_view(page_nodes(spark, sf_dir), max_depth=4, with_text=True).select(
        "file_id", "pre", "depth", "type", _text("error"), F.coalesce("truncated", F.lit(False)).alias("truncated"),
        F.coalesce("child_count", F.lit(0)).alias("child_count"), _text("text"))


@query
def page_tree_view_all(spark, sf_dir):
    return N.tree_view(page_nodes(spark, sf_dir), with_text=True).select(
        "file_id", "pre", "depth", "type", _text("error"), F.coalesce("truncated", F.lit(False)).alias("truncated"), _text("text"))


@query
def page_tree_sexp(spark, sf_dir):
    return N.tree_sexp(page_nodes(spark, sf_dir))


@query
def page_diagnostics(spark, sf_dir):
    return N.diagnostics(page_nodes(spark, sf_dir))


@query
def page_diagnostic_summary(spark, sf_dir):
    return N.diagnostic_summary(page_nodes(spark, sf_dir), 2).select(
        "file_id", "has_errors", "error_count", F.coalesce(F.size("errors"), F.lit(0)).alias("listed"), "errors_truncated")


@query
def page_diagnostic_summary_all(spark, sf_dir):
    return N.diagnostic_summary(page_nodes(spark, sf_dir)).select(
        "file_id", "has_errors", "error_count", F.coalesce(F.size("errors"), F.lit(0)).alias("listed"), "errors_truncated")


# ---------------------------------------------------------------- raw text
@query
def lexical_definitions(spark, sf_dir):
    return X.lexical_definitions(corpus(spark, sf_dir).sources).select(
        "file_id", "language", "kind", "name", "start_line", "end_line")


@query
def lexical_calls(spark, sf_dir):
    return X.lexical_calls(corpus(spark, sf_dir).sources).select("file_id", "language", "name", "line")


@query
def lexical_imports(spark, sf_dir):
    return X.lexical_imports(corpus(spark, sf_dir).sources)


@query
def lexical_references(spark, sf_dir):
    names = part_names(spark, sf_dir).unionByName(callee_names(spark, sf_dir))
    return X.lexical_references(corpus(spark, sf_dir).sources, names)


@query
def source_tokens(spark, sf_dir):
    return T.tokens(corpus(spark, sf_dir).sources, blanks=False).select("file_id", "pos", "kind", "text", "start_idx", "row", "col")


@query
def source_bracket_pairs(spark, sf_dir):
    pairs = T.bracket_pairs(T.tokens(corpus(spark, sf_dir).sources, apart=T.BRACKETS))
    return pairs.select("file_id", "pair_kind", "start_idx", "status", F.coalesce("close_start_idx", F.lit(-1)).alias("close_idx"))


@query
def page_script_calls(spark, sf_dir):
    scripts = read(spark, sf_dir, "pages").select(
        "page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r"<script[^>]*+>([\s\S]*?)</script>"), F.lit(1)))
        .alias("n", "code"),
    ).select(F.concat_ws(":", F.col("page_id").cast("string"), F.col("n").cast("string")).alias("file_id"),
             F.lit("javascript").alias("language"), "code")
    return X.lexical_calls(scripts).select("file_id", "name", "line", "col")


# ---------------------------------------------------------------- lines of documents
def _documents(spark, sf_dir):
    return read(spark, sf_dir, "documents").select(F.col("doc_id").alias("file_id"), F.col("text").alias("code"))


@query
def source_lines(spark, sf_dir):
    return L.source_lines(_documents(spark, sf_dir))


@query
def line_at(spark, sf_dir):
    """One asked row per document: its length modulo 7, often beyond the text."""
    asked = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("file_id"), (F.col("n_chars") % 7).alias("row"))
    return L.line_at(asked, _documents(spark, sf_dir), "row")


def _asked_slices(spark, sf_dir):
    return read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file_id"), (F.col("n_chars") % 5 - 1).cast("int").alias("first"),
        (F.col("n_chars") % 5 + F.col("doc_id") % 4).cast("int").alias("last"))


@query
def line_slice(spark, sf_dir):
    return L.line_slice(_asked_slices(spark, sf_dir), _documents(spark, sf_dir), F.col("first"), F.col("last"), cap=2)


@query
def line_slice_all(spark, sf_dir):
    return L.line_slice(_asked_slices(spark, sf_dir), _documents(spark, sf_dir), F.col("first"), F.col("last"))


# ---------------------------------------------------------------- files and languages
def _paths(spark, sf_dir):
    return shared_table(spark, sf_dir, "paths", odd_paths)


def odd_paths(spark, sf_dir):
    """Odd paths, sizes and explicit languages, one per supplier and part block of the order lines."""
    lines = read(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_partkey") % 64).alias("part")).distinct()
    key, part = F.col("l_suppkey"), F.col("part")
    exts = F.array(*[F.lit(x) for x in sorted(LANGUAGE_OF)])
    ext = F.when(key % 13 == 0, "xyz").otherwise(F.get(exts, ((key + part) % len(LANGUAGE_OF)).cast("int")))
    ext = F.when(key % 11 == 0, F.upper(ext)).otherwise(ext)
    folder = F.get(F.array(*[F.lit(x) for x in PATH_FOLDERS]), (part % len(PATH_FOLDERS)).cast("int"))
    stem = F.get(F.array(*[F.lit(x) for x in PATH_STEMS]), (key % len(PATH_STEMS)).cast("int"))
    path = F.concat(F.lit("pkg_"), key.cast("string"), F.lit("/"), folder, stem, part.cast("string"), F.lit("."), ext)
    given = F.when(key % 5 == 0, F.when(part % 3 == 0, "PY").when(part % 3 == 1, "rust").otherwise("cobol"))
    return lines.select(
        path.alias("path"),
        F.when(key % 17 == 0, F.lit(10485760) + part % 2).otherwise(key * 10).cast("bigint").alias("length"),
        (key % 19 == 0).alias("has_nul"), given.alias("explicit_language"),
    )


PATH_FOLDERS = ["", "src/", "node_modules/", "build/", "builds/", "outer/", "out/", "a/.git/", ".hid/", "x/venv/y/", "dist."]
PATH_STEMS = ["f", "_f", ".f", "lib.min", "g.map", "build"]


@query
def include_paths(spark, sf_dir):
    return Fi.include_paths(_paths(spark, sf_dir)).select("path")


@query
def include_language(spark, sf_dir):
    return Fi.include_paths(_paths(spark, sf_dir), language="CPP").select("path")


@query
def include_patterns(spark, sf_dir):
    return Fi.include_paths(_paths(spark, sf_dir), patterns=["**/src/*.{py,js}", "pkg_1?/f*.go"]).select("path")


@query
def exclude_paths(spark, sf_dir):
    return Fi.exclude_paths(_paths(spark, sf_dir), extra=["**/outer/**"]).select("path")


@query
def cap_files(spark, sf_dir):
    return Fi.cap_files(Fi.exclude_paths(Fi.include_paths(_paths(spark, sf_dir))), Fi.MAX_FILES).select("path")


@query
def detect_language(spark, sf_dir):
    return Fi.detect_language(_paths(spark, sf_dir)).select("path", _text("language"), _text("language_error"))


@query
def language_filter(spark, sf_dir):
    return Fi.language_filter(_paths(spark, sf_dir)).select("path")


@query
def admit(spark, sf_dir):
    return Fi.admit(_paths(spark, sf_dir))[0].select("path", "length")


def _scan_parts(spark, sf_dir):
    matched = Fi.exclude_paths(Fi.include_paths(_paths(spark, sf_dir)))
    kept = Fi.language_filter(matched)
    ok, errors = Fi.admit(kept)
    return matched, Fi.detect_language(ok, "path_only"), errors


@query
def scan_errors(spark, sf_dir):
    return S.scan_errors(_scan_parts(spark, sf_dir)[2], S.LISTED_ERRORS)


@query
def scan_errors_all(spark, sf_dir):
    return S.scan_errors(_scan_parts(spark, sf_dir)[2])


@query
def scan_summary(spark, sf_dir):
    """Path-selected files against the corpus definitions."""
    matched, _, errors = _scan_parts(spark, sf_dir)
    return S.scan_summary(Fi.scan_status(matched), stored_defs(spark, sf_dir), errors)


def _corpus_bytes(spark, sf_dir):
    """The corpus as files: some in excluded or hidden folders, of other types, with a NUL byte or too large."""
    key = F.col("file_id")
    path = (
        F.when(key % 23 == 1, F.concat(F.lit("node_modules/"), "path")).when(key % 23 == 2, F.concat(F.lit(".hid/"), "path"))
        .when(key % 23 == 3, F.concat("path", F.lit(".json"))).when(key % 23 == 4, F.concat("path", F.lit(".xyz"))).otherwise(F.col("path"))
    )
    content = F.encode("code", "UTF-8")
    return corpus(spark, sf_dir).sources.select(
        "file_id", path.alias("path"),
        F.when(key % 29 == 1, F.concat(F.unhex(F.lit("00")), content)).otherwise(content).alias("content"),
        F.when(key % 31 == 1, F.lit(Fi.MAX_BYTES + 1)).otherwise(F.octet_length("code")).cast("bigint").alias("length"),
    )


def _scan(spark, sf_dir, **options):
    return Sc.scan(_corpus_bytes(spark, sf_dir), **options,
                   keep=lambda name, df: shared_table(spark, sf_dir, "_".join([name, *options]), lambda s, d: df))


@query
def scan_files(spark, sf_dir):
    """One scan from bytes: every selected file with its state and its number of definitions, from the text."""
    return _scan(spark, sf_dir).file_totals().select("path", "language", "scanned", _text("error"), F.coalesce("total", F.lit(-1)).alias("total"))


@query
def scan_reports(spark, sf_dir):
    return _report_rows(_scan(spark, sf_dir).reports())


@query
def scan_totals(spark, sf_dir):
    """The same scan over stored candidates of the node table: totals of exactly the files it selected."""
    return _scan(spark, sf_dir, nodes=candidates(spark, sf_dir)).summary()


@query
def scan_definitions(spark, sf_dir):
    return _scan(spark, sf_dir, nodes=candidates(spark, sf_dir)).by_language()


@query
def scanned_languages(spark, sf_dir):
    return _scan_parts(spark, sf_dir)[1].groupBy("language").agg(F.count(F.lit(1)).alias("n_files"))


@query
def capabilities(spark, sf_dir):
    """Language abilities next to the corpus' number of files per language."""
    n_files = corpus(spark, sf_dir).files.groupBy("language").agg(F.count(F.lit(1)).alias("n_files"))
    able = language_capabilities(spark).withColumn("extensions", F.array_join("extensions", " "))
    return able.join(n_files, "language", "left").withColumn("n_files", F.coalesce("n_files", F.lit(0)))


@query
def unsupported_files(spark, sf_dir):
    """Per rule family, the files whose language has none of its rules."""
    files = Fi.detect_language(_paths(spark, sf_dir)).filter("language IS NOT NULL").withColumnRenamed("path", "file_id")
    return D.unsupported(files).unionByName(D.unsupported(files, "call")).unionByName(D.unsupported(files, "import"))


@query
def decode_text(spark, sf_dir):
    """Document bytes behind a byte order mark: decoded text must be the text."""
    raw = read(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.unhex(F.lit("EFBBBF")), F.encode("text", "UTF-8"), F.unhex(F.lit("FF"))).alias("content"))
    return Fi.decode_text(raw).select("doc_id", "code")
