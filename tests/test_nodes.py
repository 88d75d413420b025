"""Node views, lookups, patterns: golden cases and brute force on random trees."""

import random

import pytest
from pyspark.sql import functions as F

from codequarry.functions.intervals import containing, outside_all
from codequarry.operators import nodes as N
from codequarry.operators import patterns as P
from codequarry.operators.markup import element_nodes
from tests.helpers import NODE_SCHEMA, collect, leaf, n, t, tables


def random_tree(seed, size, line_chance, file_id="f0"):
    """A random tree over random text, as node rows; many unary chains and touching leaves."""
    rng = random.Random(seed)
    rows, text = [], []
    place = [0, 0]

    def write(chars):
        for c in chars:
            text.append(c)
            place[:] = [place[0] + 1, 0] if c == "\n" else [place[0], place[1] + 1]

    def grow(parent, depth, child_ix, budget):
        pre = len(rows)
        rows.append(None)
        start, at = len(text), tuple(place)
        kids = 0
        while budget > 1 and depth < 40 and (kids == 0 or rng.random() < 0.97):
            part = rng.randint(1, max(1, (budget - 1) // rng.choice([1, 3, 9])))
            grow(pre, depth + 1, kids, part)
            budget -= part
            kids += 1
            if rng.random() < line_chance:
                write("\n")
        own = None
        if not kids:
            own = "x" * rng.randint(0, 3)
            write(own)
        named = bool(kids) or rng.random() < 0.7
        rows[pre] = (file_id, "go", pre, len(rows) - 1, parent, depth, child_ix, rng.choice("abcd"), rng.choice([None, "f", "g"]),
                     named, False, False, start, len(text), *at, *place, own)

    grow(None, 0, 0, size)
    return rows, "".join(text)


@pytest.fixture(scope="module", params=[(1, 400, 0.3), (2, 3000, 0.0), (3, 2500, 0.05)])
def random_nodes(spark, request):
    rows, text = random_tree(*request.param)
    return rows, text, spark.createDataFrame(rows, NODE_SCHEMA).cache()


def test_ancestors_against_parents(random_nodes):
    rows, _, nodes = random_nodes
    wanted = []
    for r in rows:
        up, rank = r[4], 1
        while up is not None and rank <= 33:
            wanted.append((r[2], rank, up))
            up, rank = rows[up][4], rank + 1
    assert collect(N.ancestors(nodes, nodes), "pre", "rank", "ancestor_pre") == sorted(wanted)


@pytest.mark.parametrize("named", [True, False])
def test_node_at_against_scan(spark, random_nodes, named):
    rows, _, nodes = random_nodes
    last = rows[0]
    rng = random.Random(5)
    spots = {(r[14], r[15]) for r in rng.choices(rows, k=150)} | {(r[16], r[17]) for r in rng.choices(rows, k=150)}
    spots |= {(0, 0), (last[16], last[17]), (last[16] + 5, 0), (0, 10_000)}
    asked = spark.createDataFrame([("f0", *s) for s in spots], "file_id string, row bigint, col bigint")
    got = {(r.row, r.col): r.pre for r in N.node_at(nodes, asked, named=named).collect()}
    for spot in spots:
        inside = [r[2] for r in rows if (r[14], r[15]) <= spot < (r[16], r[17]) and (r[9] or not named)]
        assert got[spot] == (max(inside) if inside else 0)


def test_interval_joins_against_all_pairs(spark):
    rng = random.Random(9)
    spans = [(i, a, a + rng.choice([0, 1, 63, 64, 255, 256, 5000, 70_000])) for i in range(120) for a in [rng.randint(0, 90_000)]]
    points = [(i, rng.randint(0, 99_000)) for i in range(150)]
    left = spark.createDataFrame([("f", *p) for p in points], "file_id string, id int, p int")
    right = spark.createDataFrame([("f", *s) for s in spans], "file_id string, span int, lo int, hi int")
    wanted = sorted((i, s) for i, p in points for s, lo, hi in spans if lo <= p <= hi)
    assert collect(containing(left, right, "p", "lo", "hi"), "id", "span") == wanted
    assert collect(outside_all(left, right, "p", "lo", "hi"), "id") == sorted(
        (i,) for i, p in points if not any(lo <= p <= hi for _, lo, hi in spans))


def test_long_intervals_are_found_from_every_cell(spark):
    spans = [(0, 1, 3_000_000), (1, 65_535, 65_536), (2, 131_072, 1_000_000), (3, 0, 0)]
    right = spark.createDataFrame([("f", *s) for s in spans], "file_id string, span int, lo int, hi int")
    points = spark.range(0, 3_000_001, 7).select(F.lit("f").alias("file_id"), F.col("id").alias("p"))
    held = {r.span: r["count"] for r in containing(points, right, "p", "lo", "hi").groupBy("span").count().collect()}
    assert held == {i: hi // 7 - (lo - 1) // 7 for i, lo, hi in spans if hi // 7 > (lo - 1) // 7}


def test_clean_positions(spark):
    given = [("f", 1.9, -3.0), ("f", float("nan"), 0.0), ("f", 0.0, float("inf")), ("f", None, 1.0), ("f", -0.5, 2.0)]
    ok, bad = N.clean_positions(spark.createDataFrame(given, "file_id string, row double, col double"))
    assert collect(ok, "row", "col") == [(0, 2), (1, 0)]
    assert bad.count() == 3


def test_node_at_unknown_file_and_text(spark):
    nodes, src = tables(spark, ("go", [n("call", leaf("identifier", "f"), n("args", t("("), t(")")))]))
    asked = spark.createDataFrame([("f0", 0, 0), ("f0", 0, 1), ("f0", 9, 9), ("nope", 0, 0)], "file_id string, row bigint, col bigint")
    assert collect(N.node_at(nodes, asked, src), "file_id", "row", "col", "type", "text", "is_named")[:3] == [
        ("f0", 0, 0, "identifier", "f", True), ("f0", 0, 1, "args", "()", True), ("f0", 9, 9, "program", "f()", True)]
    assert N.node_at(nodes, asked, src).filter("file_id = 'nope'").first().type is None
    assert N.node_at(nodes, asked, src, named=False).filter("col = 1").first().type == "("


def test_tree_view_cases(spark):
    long = leaf("word", "y" * 100)
    nodes, src = tables(spark, ("go", [n("a", n("b", n("c", leaf("word", "x")), t(";")), n("pair", t("("), t(")")), long)]))
    view = {r.type: r for r in N.tree_view(nodes, src, max_depth=2, with_text=True).collect()}
    assert set(view) == {"program", "a", "b", "pair", "word"}
    assert (view["b"].truncated, view["b"].child_count, view["b"].text) == (True, 1, None)
    assert (view["pair"].truncated, view["pair"].text) == (None, "()")
    assert (len(view["word"].text), view["word"].text_truncated) == (80, True)
    assert view["a"].truncated is None
    assert N.tree_view(nodes, max_depth=0).count() == 2                 # clamped to 1
    assert N.tree_view(nodes).filter("text IS NOT NULL").count() == 0


def test_leaf_check_comes_before_the_limit(spark):
    nodes, _ = tables(spark, ("go", [leaf("word", "x")]))
    assert [r.truncated for r in N.tree_view(nodes, max_depth=1).collect()] == [None, None]


def test_tree_sexp(spark):
    nodes, _ = tables(
        spark, ("go", [n("call", leaf("identifier", "f", "function"), n("args", t("("), leaf("number", "1"), t(")"), field="arguments"))]),
        ("go", []), ("go", [n("ERROR", error=True)]))
    assert {r.file_id: r.sexp for r in N.tree_sexp(nodes).collect()} == {
        "f0": "(program (call function: (identifier) arguments: (args (number))))", "f1": "(program)", "f2": "(program (ERROR))"}
    lost = spark.createDataFrame(
        [("f", "go", 0, 2, None, 0, 0, "program", None, True, False, False, 0, 0, 0, 0, 0, 0, None),
         ("f", "go", 1, 1, 0, 1, 0, "word", None, True, False, True, 0, 0, 0, 0, 0, 0, ""),
         ("f", "go", 2, 2, 0, 1, 1, ";", None, False, False, True, 0, 0, 0, 0, 0, 0, "")], NODE_SCHEMA)
    assert N.tree_sexp(lost).first().sexp == '(program (MISSING word) (MISSING ";"))'


def test_tree_sexp_in_parts(random_nodes, monkeypatch):
    _, _, nodes = random_nodes
    whole = N.tree_sexp(nodes).first().sexp
    monkeypatch.setattr(N, "_PART_BITS", 5)
    assert N.tree_sexp(nodes).first().sexp == whole
    assert whole.count("(") == whole.count(")") == nodes.filter("named").count()


def test_diagnostic_summary(spark):
    bad = [n("ERROR", error=True) for _ in range(25)]
    nodes, _ = tables(spark, ("go", bad), ("go", bad[:20]), ("go", [leaf("word", "x")]))
    got = {r.file_id: r for r in N.diagnostic_summary(nodes, N.LISTED_DIAGNOSTICS).collect()}
    assert [(got[f].has_errors, got[f].error_count, len(got[f].errors or []), got[f].errors_truncated) for f in ("f0", "f1", "f2")] == [
        (True, 25, 20, True), (True, 20, 20, False), (False, 0, 0, False)]
    whole = {r.file_id: r for r in N.diagnostic_summary(nodes).collect()}
    assert (len(whole["f0"].errors), whole["f0"].errors_truncated) == (25, False)


# ---------------------------------------------------------------- patterns
CODE = [
    n("call", leaf("identifier", "f", "function"), n("args", t("("), leaf("number", "1"), t(","), leaf("string", "s"), leaf("number", "2"), t(")"), field="arguments")),
    n("call", n("attribute", leaf("identifier", "g", "object"), leaf("identifier", "h", "attribute"), field="function"), n("args", t("("), t(")"), field="arguments")),
    n("class", leaf("identifier", "K", "name")),
]


@pytest.fixture(scope="module")
def code(spark):
    return tables(spark, ("python", CODE))


def texts(matches):
    return sorted(tuple(c.text for c in r.captures) for r in matches.collect())


def test_pattern_steps(code):
    nodes, src = code
    callee = P.node("call").field("function", P.node("identifier", "attribute").capture("f")).capture("call")
    assert texts(P.match(nodes, [callee], src)) == [("f(1,s2)", "f"), ("gh()", "gh")]
    assert texts(P.match(nodes, [P.node("call").field("function", P.node("identifier").capture("f"))])) == [("f",)]
    assert texts(P.match(nodes, [P.node("class").field("name", P.node().text_is("K", "L").capture("n"))])) == [("K",)]
    assert texts(P.match(nodes, [P.node("class").field("name", P.node().text_is_not("K").capture("n"))])) == []


def test_pattern_quantifiers(code):
    nodes, _ = code
    numbers = P.node("args").any_number(P.node("number").capture("n"))
    assert texts(P.match(nodes, [numbers])) == [(), ("1", "2")]
    assert texts(P.match(nodes, [P.node("args").at_least_one(P.node("number").capture("n"))])) == [("1", "2")]
    assert texts(P.match(nodes, [P.node("args").child(P.node("number").capture("n"))])) == [("1",), ("2",)]
    assert texts(P.match(nodes, [P.node("args").optional(P.node("string").capture("s"))])) == [(), ("s",)]
    assert P.match(nodes, [P.node("class", "call").without("arguments")]).count() == 1


def test_pattern_anchors(code):
    nodes, _ = code
    after = P.node("args").child(P.node("number").capture("a")).then(P.node("string").capture("b"))
    assert texts(P.match(nodes, [after])) == [("1", "s")]
    assert texts(P.match(nodes, [P.node("args").child(P.node("number").first().capture("n"))])) == [("1",)]
    assert texts(P.match(nodes, [P.node("args").child(P.node("number").last().capture("n"))])) == [("2",)]
    gap = P.node("args").child(P.node("number").capture("a")).then(P.node("number").capture("b"))
    assert texts(P.match(nodes, [gap])) == []


def test_pattern_limits_and_regex(code):
    nodes, _ = code
    two = [P.node("call").capture("c"), P.node("identifier").text_matches("^[fg]$").capture("i")]
    with pytest.raises(ValueError):
        P.match(nodes, two)
    found = P.match(nodes, two, limit=3, allow_regex=True)
    assert found.count() == 3 and {(r.total, r.truncated) for r in found.collect()} == {(4, True)}
    exact = P.match(nodes, two, limit=4, allow_regex=True)
    assert {(r.total, r.truncated) for r in exact.collect()} == {(4, False)}
    assert {r.pattern_index for r in exact.collect()} == {0, 1}


def test_alternatives_of_different_shape(code):
    nodes, src = code
    callee = P.either(P.node("identifier").capture("f"), P.node("attribute").field("attribute", P.node("identifier").capture("f")))
    call = P.node("call").field("function", callee)
    assert texts(P.match(nodes, [call])) == [("f",), ("h",)]
    assert {r.pattern_index for r in P.match(nodes, [call]).collect()} == {0}
    # shapes of different depth and with different kinds of steps, one capture name, in one pattern
    mixed = P.either(
        P.node("call").field("function", P.node("identifier").capture("x")),
        P.node("args").any_number(P.node("number").capture("x")),
        P.node("class").without("body").field("name", P.node().capture("x")),
        P.node("args").child(P.node("number").capture("x")).then(P.node("string").capture("x")),
        P.node("call").optional(P.node("nothing")).field("function", P.node("attribute")),
    )
    assert texts(P.match(nodes, [mixed])) == [(), (), ("1", "2"), ("1", "s"), ("K",), ("f",)]
    # what is given to the whole holds for each; nested alternatives; a node that fits twice gives two matches
    whole = P.either(P.either(P.node("number"), P.node("string")), P.node("number")).first().capture("n")
    assert texts(P.match(nodes, [whole])) == [("1",), ("1",)]
    assert texts(P.match(nodes, [P.either(P.node("number"), P.node("identifier")).text_is("2", "g").capture("n")])) == [("2",), ("g",)]
    tested = P.either(P.node("call").text_is("gh()"), P.node("class")).capture("c")
    assert texts(P.match(nodes, [tested], src)) == [("K",), ("gh()",)]
    with pytest.raises(ValueError):
        P.either()
    with pytest.raises(ValueError):
        P.match(nodes, [P.either(P.node("call").text_matches("x"))])
    with pytest.raises(ValueError):
        P.match(nodes, [P.either(P.node("args").without("x")).then(P.node())])


def test_alternatives_equal_separate_patterns(code):
    nodes, src = code
    alone = [P.node("call").field("function", P.node("identifier").capture("a")), P.node("number").last().capture("a"),
             P.node("args").at_least_one(P.node("number").capture("a")), P.node("class").optional(P.node("x")).capture("a")]
    apart = sorted(t for p in alone for t in texts(P.match(nodes, [p], src)))
    assert texts(P.match(nodes, [P.either(*alone)], src)) == apart == texts(P.match(nodes, alone, src))


def test_captures_compared(spark):
    long = "x" * 300
    items = [
        n("pair", leaf("word", "a"), leaf("word", "a")), n("pair", leaf("word", "a"), leaf("word", "b")),
        n("pair", leaf("word", long + "1"), leaf("word", long + "2")),
        n("pair", n("in", t("("), leaf("word", "q"), t(")")), n("in", t("("), leaf("word", "q"), t(")"))),
        n("pair", n("in", t("("), leaf("word", "q"), t(")")), n("in", t("("), leaf("word", "r"), t(")"))),
        n("pair", n("in", t("("), leaf("word", "q"), t(")")), leaf("word", "(q)")),
        n("pair", leaf("word", "one")),
    ]
    nodes, src = tables(spark, ("python", items))
    pair = P.node("pair").child(P.node().first().capture("l")).optional(P.node().last().capture("r"))

    def kept(pattern, sources):
        # the tests on one node that is first and last as well
        return [tuple(c.text for c in r.captures) for r in P.match(nodes, [pattern], sources).orderBy("match_pre").collect()]

    clip = long[:200]
    assert kept(pair.same_text("l", "r"), src) == [("a", "a"), ("(q)", "(q)"), ("(q)", "(q)"), ("one", "one")]
    assert kept(pair.other_text("l", "r"), src) == [("a", "b"), (clip, clip), ("(q)", "(r)")]
    # without sources, inner nodes of equal length are unknown
    assert kept(pair.same_text("l", "r"), None) == [("a", "a"), ("one", "one")]
    assert kept(pair.other_text("l", "r"), None) == [("a", "b"), (clip, clip)]
    # a capture that no node has passes; several nodes under one name are all compared
    assert len(kept(pair.same_text("l", "absent").other_text("absent", "r"), src)) == 7
    words = P.node("pair").at_least_one(P.node("word").capture("w")).capture("p")
    assert len(kept(words.same_text("w", "w"), src)) == 3
    assert P.match(nodes, [P.node("pair").capture("p"), pair.same_text("l", "r")], src).groupBy("pattern_index").count().orderBy(
        "pattern_index").collect() == [(0, 7), (1, 4)]
    with pytest.raises(ValueError):
        P.match(nodes, [P.node().child(pair.same_text("l", "r"))])


def test_equal_matches_stay_apart_with_sources(code):
    nodes, src = code
    twice = P.node("args").capture("a").child(P.node("number"))
    assert texts(P.match(nodes, [twice], src)) == [("(1,s2)",), ("(1,s2)",)]
    none = P.node("args").child(P.node("number"))
    assert texts(P.match(nodes, [none], src)) == [(), ()]


# ---------------------------------------------------------------- markup
def test_element_nodes_nest(spark):
    html = "<div><b>x<i>y</b>z</i></p>\n<br>w</div><p>"
    pages = spark.createDataFrame([(1, html), (2, "")], "file_id int, html string")
    rows = {(r.file_id, r.pre): r for r in element_nodes(pages).collect()}
    assert rows[2, 0].last_desc == 0
    for (f, pre), r in rows.items():
        if pre:
            up = rows[f, r.parent]
            assert up.pre < pre <= r.last_desc <= up.last_desc and r.depth == up.depth + 1
            assert html[r.start_idx:r.end_idx] == r.leaf_text if r.leaf_text else html[r.start_idx] == "<"
    page = [rows[1, i] for i in range(rows[1, 0].last_desc + 1)]
    # The crossing pairs count as unpaired; div alone is an element, br a void one.
    assert [r.type for r in page] == ["document", "element", "start_tag", "start_tag", "text", "start_tag", "text",
                                      "erroneous_end_tag", "text", "erroneous_end_tag", "erroneous_end_tag", "element", "text",
                                      "end_tag", "start_tag"]
    assert sum(r.is_missing for r in page) == 3 and sum(r.is_error for r in page) == 3
    assert (page[1].end_row, page[1].end_col) == (1, 11)


def test_patterns_tell_named_nodes_from_tokens(code):
    nodes, _ = code
    assert P.match(nodes, [P.node("(")]).count() == 0
    unnamed = nodes.filter("NOT named").count()
    assert P.match(nodes, [P.token()]).count() == unnamed
    some = nodes.filter("NOT named").first()
    assert P.match(nodes, [P.token(some.type)]).count() == nodes.filter("NOT named").filter(nodes.type == some.type).count()


def test_text_tests_see_inner_nodes(code):
    nodes, src = code
    inner = [P.node("call").text_matches("^gh").capture("c")]
    assert texts(P.match(nodes, inner, src, allow_regex=True)) == [("gh()",)]
    other = [P.node("call").text_matches_not("^gh").capture("c")]
    assert texts(P.match(nodes, other, src, allow_regex=True)) == [("f(1,s2)",)]
    with pytest.raises(ValueError):
        P.match(nodes, other, src)


def test_then_after_an_absent_optional(code):
    nodes, _ = code
    either = P.node("args").optional(P.node("nothing").capture("x")).then(P.node("number").capture("n"))
    assert texts(P.match(nodes, [either])) == [("1",), ("2",)]


def test_node_at_with_ancestors(spark, code):
    nodes, _ = code
    asked = spark.createDataFrame([("f0", 0, 0), ("f0", 0, 2), ("f0", 99, 0), ("nowhere", 0, 0)], "file_id string, row long, col long")
    got = {(r.file_id, r.row, r.col): r for r in N.node_at_with_ancestors(nodes, asked).collect()}
    assert [(got["f0", 0, 0].type, [(a.rank, a.type) for a in got["f0", 0, 0].ancestors])] == [("identifier", [(1, "call"), (2, "program")])]
    assert [a.type for a in got["f0", 0, 2].ancestors] == ["args", "call", "program"]
    assert (got["f0", 99, 0].type, got["f0", 99, 0].ancestors) == ("program", [])
    assert (got["nowhere", 0, 0].type, got["nowhere", 0, 0].ancestors) == (None, None)
    short = N.node_at_with_ancestors(nodes, asked, listed=1).filter("col = 2").first()
    assert [a.type for a in short.ancestors] == ["args"]


def test_matches_used_twice_are_stored_and_found_once(spark, tmp_path):
    items = [n("pair", n("in", t("("), leaf("word", "q"), t(")")), n("in", t("("), leaf("word", x), t(")"))) for x in "qqr"]
    nodes, src = tables(spark, ("python", items))
    pair = P.node("pair").child(P.node().first().capture("l")).child(P.node().last().capture("r"))
    patterns = [pair.same_text("l", "r"), P.node("word"), pair.other_text("l", "r")]
    stored = []

    def keep(name, rows):
        stored.append((name, rows.count()))
        rows.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    plain = collect(P.match(nodes, patterns, src), "pattern_index", "match_pre", "captures")
    assert collect(P.match(nodes, patterns, src, keep=keep), "pattern_index", "match_pre", "captures") == plain
    assert [x[0] for x in plain] == [0, 0, 1, 1, 1, 1, 1, 1, 2]
    # three pairs for two patterns over them, and six words
    assert stored == [("found", 9), ("compared", 9)]
