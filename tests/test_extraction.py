"""Definitions, calls, imports, references, outlines, reports: quirks on hand-written trees."""

import random

import pytest
from pyspark.sql import functions as F

from codequarry.operators import calls as C
from codequarry.operators import definitions as D
from codequarry.operators import imports as I
from codequarry.operators import nodes as N
from codequarry.operators import outline as O
from codequarry.operators import references as R
from codequarry.operators import report as S
from codequarry.plans import templates as T
from codequarry.plans.corpus import corpus
from codequarry.sources.rules import rule_set
from tests.helpers import NODE_SCHEMA, collect, leaf, n, t, tables

DEF_SCHEMA = (
    "file_id string, language string, kind string, name string, start_line int, end_line int, name_row int, kind_pre int, "
    "pattern_ix int, name_pre int"
)


def raw(spark, *rows):
    """Definition matches from (file, kind, name, start, end, position)."""
    return spark.createDataFrame([(f, "go", k, nm, s, e, s - 1, at, 0, at + 1) for f, k, nm, s, e, at in rows], DEF_SCHEMA)


def test_higher_rank_replaces_and_ties_keep_the_first(spark):
    defs = raw(
        spark, ("f", "type", "A", 1, 2, 1), ("f", "struct", "A", 1, 9, 5), ("f", "function", "B", 1, 3, 2), ("f", "export", "B", 1, 4, 3),
        ("f", "class", "C", 1, 1, 4), ("f", "interface", "C", 1, 1, 6), ("f", "function", "A", 2, 2, 9), ("g", "type", "A", 1, 1, 1))
    kept = D.dedupe(defs)
    assert collect(kept, "file_id", "name", "start_line", "kind", "end_line") == [
        ("f", "A", 1, "struct", 9), ("f", "A", 2, "function", 2), ("f", "B", 1, "function", 3), ("f", "C", 1, "class", 1),
        ("g", "A", 1, "type", 1)]
    # The survivor stands where the first match of its key stood.
    assert [r.name for r in D.ordered(kept.filter("file_id = 'f'")).collect()] == ["A", "B", "C", "A"]


def test_dedupe_is_idempotent(spark, sf_dir):
    data = corpus(spark, sf_dir)
    once = D.definitions(data.nodes, data.sources)
    again = D.dedupe(once)
    cols = ("file_id", "kind", "name", "start_line", "end_line")
    assert collect(once, *cols) == collect(again, *cols)


def test_kinds_outside_the_list_are_dropped(spark):
    nodes, src = tables(spark, ("go", [n("thing", leaf("identifier", "x", "name"))]))
    rules = rule_set("definition", [("go", "gadget", "identifier", "name", "thing"), ("go", "module", "identifier", "name", "thing")])
    assert collect(D.definitions(nodes, src, rules), "kind", "name") == [("module", "x")]


def test_definition_without_name_text_reads_the_source(spark):
    nodes, src = tables(spark, ("cpp", [T.CPP[5].items[0]]))
    assert [r.name for r in D.definitions(nodes, src).collect()] == ["T::n_000000000000"]
    assert D.definitions(nodes).count() == 0


def test_file_results_in_parts(spark, monkeypatch):
    monkeypatch.setattr(D, "_PART_BITS", 3)
    defs = D.dedupe(raw(spark, *[("f", "class" if i % 2 else "method", f"n{i}", i + 1, i + 1, 2 * i) for i in range(20)]))
    files = spark.createDataFrame([("f",), ("empty",)], "file_id string")
    rows = sorted(D.file_results(defs, files).collect(), key=lambda r: (r.file_id, r.part))
    assert (rows[0].total, rows[0].by_kind, rows[0].definitions) == (0, {}, None)
    assert len(rows) == 6 and {r.total for r in rows[1:]} == {20} and rows[1].by_kind == {"class": 10, "method": 10}
    assert [d.name for r in rows[1:] for d in r.definitions] == [f"n{i}" for i in range(20)]


def test_unsupported(spark):
    files = spark.createDataFrame([("a", "json"), ("b", "php")], "file_id string, language string")
    assert collect(D.unsupported(files), "file_id") == [("a",)]
    assert collect(D.unsupported(files, "import"), "file_id", "error") == [
        ("a", "no import rules for json"), ("b", "no import rules for php")]


# ---------------------------------------------------------------- calls
def call(name):
    return n("call", leaf("identifier", name, "function"), n("argument_list", t("("), t(")"), field="arguments"))


def test_top_callees_ties_go_to_the_first(spark):
    nodes, _ = tables(spark, ("python", [call(x) for x in "bacab"] + [call(f"z{i:02}") for i in range(40)]))
    top = [r.name for r in C.top_callees(C.calls(nodes)).orderBy("rank").collect()]
    assert top[:3] == ["b", "a", "c"] and len(top) == 30 and top[3] == "z00"


def test_listed_calls_keep_the_total(spark):
    nodes, _ = tables(spark, ("python", [call("x") for _ in range(501)]))
    rows = C.listed_calls(C.calls(nodes), 500).collect()
    assert len(rows) == 500 and {r.total for r in rows} == {501}
    whole = C.listed_calls(C.calls(nodes)).collect()
    assert len(whole) == 501 and {r.total for r in whole} == {501} and {r["rank"] for r in whole} == set(range(1, 502))


def test_php_names_lose_their_namespace(spark):
    nodes, src = tables(spark, ("php", [n("function_call_expression", n("qualified_name", leaf("x", "A\\B\\f"), field="function"))]),
                        ("php", [n("function_call_expression", n("qualified_name", leaf("x", "A\\"), field="function"))]))
    assert collect(C.calls(nodes, src), "file_id", "name") == [("f0", "f"), ("f1", "")]


def test_nested_calls_count_by_name_place(spark):
    outer = n("call", n("attribute", call("in"), t("."), leaf("identifier", "out", "attribute"), field="function"))
    nodes, _ = tables(spark, ("python", [outer]))
    assert [r.name for r in C.listed_calls(C.calls(nodes)).orderBy("rank").collect()] == ["in", "out"]


# ---------------------------------------------------------------- imports
def test_imports_that_do_not_match(spark):
    nodes, src = tables(spark, ("python", list(T.PYTHON[0].items)), ("go", [n("import_spec", leaf("raw_string_literal", "`m`", "path"))]))
    assert collect(I.imports(nodes, src), "module", "line") == [("mod_00", 1), ("mod_00", 2)]


def test_long_import_text(spark):
    long = "a::" * 3000 + "z"
    nodes, src = tables(spark, ("rust", [n("use_declaration", t("use"), " ", n("scoped", leaf("w", long), field="argument"), t(";"))]))
    row = I.imports(nodes, src).first()
    assert row.module == long and row.raw == ("use " + long)[:200]


def test_degrees(spark):
    rows = [("f", "m"), ("f", "m"), ("f", "k"), ("g", "m"), ("h", None)]
    found = spark.createDataFrame(rows, "file_id string, module string")
    edges = I.import_edges(found)
    assert collect(I.module_degrees(edges), "module", "in_degree", "n_imports") == [("k", 1, 1), ("m", 2, 3)]
    assert collect(I.file_degrees(edges, found.select("file_id").distinct()), "file_id", "out_degree") == [("f", 2), ("g", 1), ("h", 0)]


# ---------------------------------------------------------------- references
def test_references(spark):
    composed, decomposed = "\u00e9", "e\u0301"
    nodes, src = tables(
        spark,
        ("javascript", ["  ", leaf("identifier", composed), "\n", leaf("identifier", decomposed), n("string", leaf("identifier", composed)),
                        n("template_string", n("template_substitution", n("call", leaf("identifier", composed)))),
                        leaf("number", composed)]),
        ("bash", [n("command", n("command_name", leaf("word", "ls")))]),
    )
    asked = spark.createDataFrame([(composed,), ("ls",), ("none",), ("",)], "name string")
    got = collect(R.references(nodes, asked, src), "file_id", "name", "line", "col", "context")
    second = src.filter("file_id = 'f0'").first().code.split("\n")[1]
    assert got == sorted([("f0", composed, 1, 3, composed), ("f0", composed, 2, 1, second), ("f1", "ls", 1, 1, "ls")])


def test_reference_limit_flag(spark):
    nodes, _ = tables(spark, ("go", [leaf("identifier", "x") for _ in range(5)]))
    found = R.references(nodes, spark.createDataFrame([("x",)], "name string"))
    assert {(r.total, r.truncated) for r in R.limited(found, 5).collect()} == {(5, False)}
    assert [r.col for r in R.limited(found, 2).orderBy("pre").collect()] == [1, 2]
    assert {r.truncated for r in R.limited(found, 2).collect()} == {True}


# ---------------------------------------------------------------- outlines
def stack_levels(spans):
    open_, levels = [], []
    for start, end in spans:
        while open_ and open_[-1] < start:
            open_.pop()
        levels.append(len(open_))
        open_.append(end)
    return levels


@pytest.mark.parametrize("bits", [0, 2, 12])
def test_outline_levels_against_a_stack(spark, monkeypatch, bits):
    monkeypatch.setattr(O, "_BLOCK_BITS", bits)
    rng = random.Random(7)
    files = {"overlap": [(1, 3), (3, 5), (4, 4)]}
    for f in range(12):
        starts = sorted(rng.randint(1, 40) for _ in range(rng.randint(1, 60)))
        files[f"r{f}"] = [(s, s + rng.choice([0, 0, 1, 3, 10, 60])) for s in starts]
    defs = D.dedupe(raw(spark, *[(f, "function", f"n{i}", s, e, 2 * i + 1) for f, spans in files.items() for i, (s, e) in enumerate(spans)]))
    got = {}
    for r in O.outline_levels(defs).collect():
        got.setdefault(r.file_id, {})[int(r.name[1:])] = r.level
    assert {f: [v[i] for i in sorted(v)] for f, v in got.items()} == {f: stack_levels(s) for f, s in files.items()}


def test_outlines_of_one_block_are_computed_once(spark):
    """Stacks on entry are found for files of several blocks alone, and text takes its totals from the definitions."""
    spans = {"f": [(1, 9, 1), (2, 3, 5)], "g": [(1, 9, 1), (2, 8, 5000), (3, 4, 9000)]}
    defs = D.dedupe(raw(spark, *[(f, "class", f"n{seen}", s, e, seen) for f, rows in spans.items() for s, e, seen in rows]))
    levels = O.outline_levels(defs)
    assert collect(levels, "file_id", "level") == [("f", 0), ("f", 1), ("g", 0), ("g", 1), ("g", 2)]
    assert "LeftSemi" in levels._jdf.queryExecution().optimizedPlan().toString()
    files = spark.createDataFrame([("f", "a", "go"), ("g", "b", "go"), ("h", "c", "go")], "file_id string, path string, language string")
    once, twice = O.outline_text(levels, files, defs), O.outline_text(levels, files)
    assert collect(once, "file_id", "part", "outline") == collect(twice, "file_id", "part", "outline")


def test_outline_text(spark):
    defs = D.dedupe(raw(spark, ("f", "class", "A", 1, 9, 1), ("f", "method", "b", 2, 3, 5)))
    files = spark.createDataFrame([("f", None, "go"), ("g", "p/q.go", "go")], "file_id string, path string, language string")
    assert {r.file_id: r.outline for r in O.outline_text(O.outline_levels(defs), files).collect()} == {
        "f": "# <inline> [go]\n# 2 definitions\nL1: class A\n  L2: method b", "g": "# p/q.go [go]\n# 0 definitions"}


# ---------------------------------------------------------------- reports
def test_report_flags_and_zero_rows(spark):
    files = spark.createDataFrame([(f"f{i:03}", f"p{i:03}", "go" if i else "rust") for i in range(201)],
                                  "file_id string, path string, language string")
    defs = D.dedupe(raw(spark, *[("f001", "struct", f"n{i}", i + 1, i + 1, 2 * i) for i in range(7)]))
    none = spark.createDataFrame([], "path string, stage string, error string")
    row = S.scan_summary(files, defs, none).first()
    assert row.asDict() == {"files_matched": 201, "files_scanned": 201, "files_truncated": True, "total_definitions": 7,
                            "n_errors": 0, "errors_truncated": False}
    assert S.scan_summary(files, defs, none, reported=201).first().files_truncated is False
    assert collect(S.by_language(files, defs), "language", "n_definitions") == [("go", 7), ("rust", 0)]
    reports = {r.file_id: r for r in S.file_reports(files, defs, max_files=200, limit_per_file=5).collect()}
    assert len(reports) == 200 and "f200" not in reports
    assert (reports["f001"].total, [d.name for d in reports["f001"].definitions]) == (7, [f"n{i}" for i in range(5)])
    assert (reports["f000"].total, reports["f000"].definitions) == (0, None)
    whole = {r.file_id: r for r in S.file_reports(files, defs).collect()}
    assert len(whole) == 201 and len(whole["f001"].definitions) == 7


def test_totals_agree(spark, sf_dir):
    data = corpus(spark, sf_dir)
    defs = D.definitions(data.nodes, data.sources)
    total = defs.count()
    add = lambda df, c: df.agg(F.sum(c)).first()[0]
    assert total == add(S.by_kind(defs), "n_definitions") == add(S.by_language(data.files, defs), "n_definitions")
    assert total == S.rollup(defs).filter("level = 3").first().n_definitions
    assert total == add(D.count_by_kind(defs), "n")


def test_corpus_is_consistent(spark, sf_dir):
    data = corpus(spark, sf_dir)
    both = data.nodes.join(data.sources.select("file_id", "code"), "file_id")
    wrong = "leaf_text IS NOT NULL AND substring(code, start_idx + 1, end_idx - start_idx) <> leaf_text"
    assert both.filter(wrong).count() == 0
    up = data.nodes.select("file_id", F.col("pre").alias("parent"), F.col("last_desc").alias("up_last"), F.col("depth").alias("up_depth"))
    kids = data.nodes.filter("parent IS NOT NULL").join(up, ["file_id", "parent"], "left")
    assert kids.filter("up_last IS NULL OR pre <= parent OR last_desc > up_last OR depth <> up_depth + 1").count() == 0


def test_deep_chain_lists_all_ancestors_or_the_nearest(spark):
    rows = [("f", "go", i, 59, i - 1 if i else None, i, 0, f"t{i}", None, True, False, False, 0, 1, 0, 0, 0, 1, None) for i in range(60)]
    nodes = spark.createDataFrame(rows, NODE_SCHEMA)
    keys = spark.createDataFrame([("f", 59)], "file_id string, pre int")
    assert [r.ancestor_pre for r in N.ancestors(nodes, keys).orderBy("rank").collect()] == list(range(58, -1, -1))
    assert [r.ancestor_pre for r in N.ancestors(nodes, keys, 33).orderBy("rank").collect()] == list(range(58, 25, -1))
    assert N.tree_view(nodes).count() == 60 and N.tree_view(nodes, max_depth=8).count() == 9
