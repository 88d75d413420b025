"""Lines, cuts, trimming, lexing and masking."""

import random

import pytest
from pyspark.sql import functions as F

from codequarry.functions.lexicon import LEXICONS
from codequarry.functions.limits import first_k
from codequarry.functions.text import split_lines, to_nfc, trim_ws, unquote
from codequarry.operators import lines as L
from codequarry.operators.lexical import masked
from codequarry.operators.tokens import BRACKETS, bracket_pairs, page_pairs, page_tokens, tokens
from tests.helpers import collect, sources


def one(spark, column, **cells):
    df = spark.createDataFrame([tuple(cells.values())], ", ".join(f"{c} string" for c in cells))
    return df.select(column.alias("x")).first().x


def test_split_lines(spark):
    assert one(spark, split_lines(F.col("s")), s="a\r\nb\rc\n") == ["a", "b\rc", ""]
    assert one(spark, split_lines(F.col("s")), s="") == [""]


@pytest.mark.parametrize("given, wanted", [
    ("  a b \t", "a b"), (" ﻿x ", "x"), ("　", ""), ("a" + " " * 50 + "b", "a" + " " * 50 + "b"),
])
def test_trim_ws(spark, given, wanted):
    assert one(spark, trim_ws(F.col("s")), s=given) == wanted


@pytest.mark.parametrize("given, wanted", [
    ('"m"', "m"), ("'m", "m"), ('m"', "m"), ("`m`", "`m`"), ("\"'m'\"", "'m'"), ('"', ""), ("", ""),
])
def test_unquote(spark, given, wanted):
    assert one(spark, unquote(F.col("s")), s=given) == wanted


def test_nfc_only_changes_what_is_decomposed(spark):
    composed, decomposed, joined = "\u00e9", "e\u0301", "e\u200d"
    df = spark.createDataFrame([(composed,), (decomposed,), ("e",), (joined,), (None,)], "s string")
    got = {r.s: r.nfc for r in to_nfc(df, "s", "nfc").collect()}
    assert got == {composed: composed, decomposed: composed, "e": "e", joined: joined, None: None}


def test_line_at_and_missing_lines(spark):
    src = sources(spark, "python", "a\nb")
    rows = spark.createDataFrame([("f0", 0), ("f0", 1), ("f0", 7), ("gone", 0)], "file_id string, row int")
    assert collect(L.line_at(rows, src, "row"), "file_id", "row", "text") == [
        ("f0", 0, "a"), ("f0", 1, "b"), ("f0", 7, ""), ("gone", 0, "")]


@pytest.mark.parametrize("first, last, cap, text, cut", [
    (2, 3, 9, "b\nc", False), (-4, 2, 9, "a\nb", False), (3, 99, 9, "c\nd", False), (1, 4, 2, "a\nb", True),
    (9, 12, 9, "", False), (3, 2, 9, "", False), (1, 4, 4, "a\nb\nc\nd", False), (2, 3, 0, "", True), (2, None, None, "b\nc\nd", False),
    (None, 1, None, "a", False),
])
def test_line_slice(spark, first, last, cap, text, cut):
    src = sources(spark, "python", "a\nb\nc\nd")
    rows = spark.createDataFrame([("f0",)], "file_id string")
    got = L.line_slice(rows, src, F.lit(first).cast("int"), F.lit(last).cast("int"), cap).first()
    assert (got.text, got.truncated) == (text, cut)


@pytest.mark.parametrize("cap", [None, 1, 64, 100])
def test_slices_over_blocks_of_lines(spark, cap):
    lines = [f"line {i}" for i in range(300)] + [""]
    src = sources(spark, "python", "\r\n".join(lines)).unionByName(spark.createDataFrame(
        [("none", "p", "python", None), ("empty", "q", "python", "")], "file_id string, path string, language string, code string"))
    spans = [(1, 300), (64, 64), (64, 65), (65, 128), (1, 64), (2, 257), (300, 400), (301, 301), (302, 310), (128, 129), (128, 129)]
    rows = spark.createDataFrame([(f, a, b) for a, b in spans for f in ("f0", "none", "empty", "gone", None)], "file_id string, a int, b int")
    got = L.line_slice(rows, src, F.col("a"), F.col("b"), cap).collect()
    assert len(got) == 5 * len(spans)
    for r in got:
        of = {"f0": lines, "empty": [""]}.get(r.file_id, [])[r.a - 1 : r.b]
        assert (r.text, r.truncated) == ("\n".join(of if cap is None else of[:cap]), cap is not None and len(of) > cap)
    at = spark.createDataFrame([("f0", i) for i in (-1, 0, 63, 64, 127, 128, 299, 300, 301, None)], "file_id string, row int")
    assert {r.row: r.text for r in L.line_at(at, src, "row").collect()} == {
        -1: "", 0: "line 0", 63: "line 63", 64: "line 64", 127: "line 127", 128: "line 128", 299: "line 299", 300: "", 301: "", None: ""}


def defs(spark, start, end):
    return spark.createDataFrame([("f0", start, end, start - 1)], "file_id string, start_line int, end_line int, name_row int")


def test_body_is_widened_and_capped(spark):
    src = sources(spark, "python", "\n".join(str(i) for i in range(1, 6101)))
    got = L.with_body(defs(spark, 10, 12), src, 1, 2).first()
    assert (got.body, got.body_truncated) == ("9\n10\n11\n12\n13\n14", None)
    got = L.with_body(defs(spark, 1, 6000), src).first()
    assert got.body.count("\n") == 5999 and got.body_truncated is None
    got = L.with_body(defs(spark, 1, 6000), src, cap=L.BODY_LINES).first()
    assert got.body.count("\n") == 4999 and got.body_truncated is True


def test_context_is_whole_unless_bounded(spark):
    src = sources(spark, "python", "\n".join(str(i) for i in range(1, 1001)))
    got = L.with_context(defs(spark, 500, 500), src, 999, -3).first()
    assert got.context.split("\n")[0] == "1" and got.context.split("\n")[-1] == "500" and got.context_truncated is None
    got = L.with_context(defs(spark, 500, 500), src, 200, 0, cap=3).first()
    assert got.context == "300\n301\n302" and got.context_truncated is True
    assert L.with_context(defs(spark, 500, 500), src).first().context is None


def test_signature_is_trimmed_and_clipped(spark):
    src = sources(spark, "python", "\t def f" + "x" * 300)
    assert len(L.signature(defs(spark, 1, 1), src).first().signature) == 200


def test_cuts_across_chunks(spark):
    text = "".join(chr(0x1F600 + i % 50) if i % 7 == 0 else chr(97 + i % 26) for i in range(10_000))
    src = sources(spark, "python", text)
    spans = [(0, 5), (4090, 4100), (4095, 4096), (4096, 4097), (100, 9000), (9990, 10_000), (8191, 8193), (50, 50)]
    rows = spark.createDataFrame([("f0", a, b) for a, b in spans], "file_id string, a int, b int")
    for r in L.cut_clipped(rows, src, "a", "b", 200, "text").collect():
        assert r.text == text[r.a:min(r.b, r.a + 200)]
    whole = L.cut_whole(rows.withColumn("text", F.when(F.col("a") == 0, "kept")), src, "a", "b", "text").collect()
    assert {(r.a, r.b): r.text for r in whole} == {(a, b): "kept" if a == 0 else text[a:b] for a, b in spans}


CODE = {
    "python": 'x = """a # b\n"""  # c\ny = \'q\\\'s\' # é\n',
    "javascript": "a = `t\n${b}` /* c\n d */ // e\n$f('g\\'')",
    "rust": "fn f<'a>(x: &'a str) { 'b'; \"c\n\" } // d",
    "bash": "a='b#c' \"d\n\" # e\n${f}",
    "php": "<?php $a = 'b'; # c\n/* d */ e();",
}


@pytest.mark.parametrize("language", CODE)
def test_tokens_tile_the_text(spark, language):
    code = CODE[language]
    toks = sorted(tokens(sources(spark, language, code)).collect(), key=lambda r: r.pos)
    assert "".join(r.text for r in toks) == code
    for r in toks:
        assert code[r.start_idx:r.end_idx] == r.text
        before = code[:r.start_idx]
        assert (r.row, r.col) == (before.count("\n"), len(before) - before.rfind("\n") - 1)


@pytest.mark.parametrize("language, strings, comments", [
    ("python", ['"""a # b\n"""', "'q\\'s'"], ["# c", "# é"]),
    ("javascript", ["`t\n${b}`", "'g\\''"], ["/* c\n d */", "// e"]),
    ("rust", ["'b'", '"c\n"'], ["// d"]),
    ("bash", ["'b#c'", '"d\n"'], ["# e"]),
    ("php", ["'b'"], ["# c", "/* d */"]),
])
def test_token_kinds(spark, language, strings, comments):
    toks = sorted(tokens(sources(spark, language, CODE[language])).collect(), key=lambda r: r.pos)
    assert [r.text for r in toks if r.kind == "string"] == strings
    assert [r.text for r in toks if r.kind == "comment"] == comments


def test_long_tokens_do_not_recurse(spark):
    code = "/*" + "x*y/ " * 200_000 + "*/ '" + "\\'a" * 200_000 + "'"
    assert [r.kind for r in tokens(sources(spark, "javascript", code)).orderBy("pos").collect()] == [
        "comment", "space", "string"]


@pytest.mark.parametrize("language", ["python", "javascript", "php", "bash"])
def test_tokens_without_blanks(spark, language):
    code = "  a = 'b ' # c \t\r\n\f# d\n\n/* e */  // f  \r\n\"g  \n\th \" \\ \v \u00a0 \u00e9  # "
    src = sources(spark, language, code, "", "  \n", "x", "x // y ", "# z \n")
    columns = ("file_id", "pos", "kind", "text", "start_idx", "end_idx", "row", "col")
    assert collect(tokens(src, blanks=False), *columns) == collect(tokens(src).filter("kind <> 'space'"), *columns)
    with pytest.raises(ValueError):
        tokens(src, apart="{", blanks=False)


def test_tokens_in_runs(spark):
    """Runs between strings, comments and single characters: all of these stay where they are, in any text."""
    rng = random.Random(3)
    codes = [(f"{x}{i}", x, "".join(rng.choice(" ab1$_\u00e9\t\n\n\\{};()[]\"'`/*#<") for _ in range(150))) for x in LEXICONS for i in range(15)]
    src = spark.createDataFrame([*codes, *[(f"c{x}", x, code) for x, code in CODE.items()]], "file_id string, language string, code string")
    held = ("file_id", "language", "start_idx", "end_idx", "row", "col", "kind", "text")

    def shown(toks):
        looked = F.col("kind").isin("string", "comment") | F.col("text").isin("{", "}", ";")
        return collect(toks.filter(looked), *held)

    runs = tokens(src, apart="{};").cache()
    assert shown(runs) == shown(tokens(src))
    assert {r.kind for r in runs.select("kind").distinct().collect()} == {"string", "comment", "other", "run"}
    assert runs.filter((F.col("kind") == "run") & F.col("text").rlike("[{};]")).count() == 0
    whole = runs.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("pos", "text")))["text"].alias("x"))
    assert whole.join(src, "file_id").filter(F.array_join("x", "") != F.col("code")).count() == 0
    pairs = ("file_id", "pair_kind", "start_idx", "status", "close_start_idx", "depth")
    brackets = [tuple(r) for t in (tokens(src, apart=BRACKETS), tokens(src)) for r in [bracket_pairs(t).select(*pairs).orderBy(*pairs).collect()]]
    assert brackets[0] == brackets[1]


def test_masked_in_any_text(spark):
    """What strings and comments become follows from the tokens."""
    rng = random.Random(5)
    codes = [(f"{x}{i}", x, "".join(rng.choice(" ab$\t\n\n\\{};\"'`/*#") for _ in range(150))) for x in LEXICONS for i in range(10)]
    src = spark.createDataFrame(codes, "file_id string, language string, code string")
    made = {}
    for r in sorted(tokens(src).collect(), key=lambda r: (r.file_id, r.pos)):
        text = r.text
        if r.kind == "comment":
            text = "".join(c if c in "\r\n" else " " for c in text)
        elif r.kind == "string":
            head, line, tail = text.partition("\n")
            text = "".join(c if c in "\r\n" else '"' for c in head) + line + "".join(c if c in "\r\n" else "\x01" for c in tail)
        made[r.file_id] = made.get(r.file_id, "") + text
    got = src.select("file_id", masked(F.col("code"), F.col("language")).alias("m")).collect()
    assert {r.file_id: r.m for r in got} == made


def test_masked_keeps_lengths(spark):
    for language, code in CODE.items():
        got = one(spark, masked(F.col("s"), F.col("l")), s=code, l=language)
        assert len(got) == len(code) and got.count("\n") == code.count("\n")
    assert "c" not in one(spark, masked(F.col("s"), F.col("l")), s=CODE["php"].replace("php", "x"), l="php")


def test_bracket_pairs(spark):
    got = collect(bracket_pairs(tokens(sources(spark, "go", ") ( [ ) ] ( {"))), "start_idx", "pair_kind", "status", "depth")
    assert got == [(0, "(", "error", 0), (2, "(", "paired", 0), (4, "[", "paired", 0), (10, "(", "missing", 0),
                   (12, "{", "missing", 0)]


def test_page_pairs(spark):
    pages = spark.createDataFrame([(1, "<p><b>x<p>y</p></i><br><hr/><script>if (a</b>)</script></P>")], "file_id int, html string")
    toks = page_tokens(pages)
    kinds = [r.kind for r in toks.orderBy("pos").collect()]
    assert kinds == ["open", "open", "text", "open", "text", "close", "close", "void", "void", "script_element", "close"]
    assert collect(page_pairs(toks), "pos", "pair_kind", "status", "close_pos") == [
        (0, "p", "paired", 10), (1, "b", "missing", None), (3, "p", "paired", 5), (6, "i", "error", None)]


@pytest.mark.parametrize("k", [3, 1500])
def test_first_k_of_a_hot_group(spark, k):
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("g"), "id")
    got = collect(first_k(df, ["g"], [F.desc("id")], k), "g", "rank", "id")
    wanted = []
    for g, ids in (("cold", [i for i in range(20_000) if i % 10 == 9]), ("hot", [i for i in range(20_000) if i % 10 < 9])):
        wanted += [(g, r + 1, i) for r, i in enumerate(sorted(ids, reverse=True)[:k])]
    assert got == sorted(wanted)
