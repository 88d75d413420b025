"""Raw-text extraction on realistic snippets."""

import pytest
from pyspark.sql import functions as F

from codequarry.functions.layout import once_and_again
from codequarry.operators import lexical as X
from codequarry.operators import tokens as T
from tests.helpers import collect, sources

SNIPPETS = {
    "python": ("@wrap\nasync def a(\n    x,\n    y):\n    s = '''\ndef no(): pass\n'''\n    return b(x)\n\nclass C(D):\n\tdef m(self):\n\t\tpass\n\n\tz = 1\n# def no2()\n",
               [("function", "a", 2, 8), ("class", "C", 10, 14), ("function", "m", 11, 12)]),
    "javascript": ("export default async function a() {\n  if (x) { y(); }\n}\nclass B {\n  static m(q) {\n    return 1;\n  }\n}\nconst c = async x => {\n  d(x);\n};\nlet n = 3;\n",
                   [("export", "a", 1, 3), ("class", "B", 4, 8), ("method", "m", 5, 7), ("function", "c", 9, 11)]),
    "go": ("package p\n\nimport (\n\t\"a/b\"\n\tx \"c\"\n)\n\ntype (\n\tA struct {\n\t}\n\tB int\n)\n\nfunc (r *T) M() error {\n\treturn nil\n}\n\ntype I interface {\n\tF()\n}\n",
           [("struct", "A", 8, 12), ("type", "B", 8, 12), ("method", "M", 14, 16), ("interface", "I", 18, 20)]),
    "java": ("public class A {\n  private final int x = f(1);\n  public A(int x) {\n    this.x = x;\n  }\n  static List<String> g(int a) throws E {\n    return new B() {};\n  }\n}\n",
             [("class", "A", 1, 9), ("constructor", "A", 3, 5), ("method", "g", 6, 8)]),
    "rust": ("pub struct P(i32);\nimpl<T> Show for Q {\n    pub fn s(&self) -> char { '}' }\n}\ntrait R {}\n",
             [("struct", "P", 1, 1), ("impl", "Q", 2, 4), ("function", "s", 3, 3), ("trait", "R", 5, 5)]),
    "c": ("#include \"a.h\"\nstatic int f(int a) {\n  if (a) { g(); }\n  return h(a);\n}\nstruct S {\n  int x;\n};\nint proto(int);\n",
          [("function", "f", 2, 5), ("struct", "S", 6, 8)]),
    "cpp": ("int A::b(int c) const {\n  return c;\n}\nclass D : public E {\n};\n", [("method", "A::b", 1, 3), ("class", "D", 4, 5)]),
    "ruby": ("module M\n  class K\n    def self.f(x)\n      g(x)\n    end\n  end\nend\n",
             [("module", "M", 1, 7), ("class", "K", 2, 6), ("method", "f", 3, 5)]),
    "bash": ("function a() {\n  ls -l | grep x\n}\nb() { echo hi; }\n", [("function", "a", 1, 3), ("function", "b", 4, 4)]),
    "php": ("<?php\nabstract class A {\n  public static function m() { return f(1); }\n}\nfunction &g() {\n}\n",
            [("class", "A", 2, 4), ("method", "m", 3, 3), ("function", "g", 5, 6)]),
    "typescript": ("export interface I {\n  a: string;\n}\nexport type T<K> = { k: K };\nenum E { A }\nexport const f = (x: number): number => {\n  return x;\n};\n",
                   [("interface", "I", 1, 3), ("type", "T", 4, 4), ("enum", "E", 5, 5), ("export", "f", 6, 8)]),
}


@pytest.mark.parametrize("language", SNIPPETS)
def test_lexical_definitions(spark, language):
    code, wanted = SNIPPETS[language]
    got = collect(X.lexical_definitions(sources(spark, language, code, code.replace("\n", "\r\n"))),
                  "file_id", "kind", "name", "start_line", "end_line")
    assert got == sorted((f, *w) for f in ("f0", "f1") for w in wanted)


@pytest.mark.parametrize("language, names", [
    ("python", ["b"]), ("javascript", ["d", "y"]), ("c", ["g", "h"]), ("ruby", ["g"]), ("bash", ["echo", "grep", "ls"]), ("php", ["f"]),
])
def test_lexical_calls(spark, language, names):
    assert [r[0] for r in collect(X.lexical_calls(sources(spark, language, SNIPPETS[language][0])), "name")] == names


@pytest.mark.parametrize("language, code, wanted", [
    ("python", "import a, b.c as d, e  # f\nfrom .g import h\nfrom i.j import k\n'''\nimport no\n'''\n",
     [("a", 1, "import a, b.c as d, e"), ("e", 1, "import a, b.c as d, e"), ("i.j", 3, "from i.j import k")]),
    ("javascript", "import 'a';\nimport b from \"c\"; // d\nconst e = require('f');\n/* import g from 'h'; */\n",
     [("a", 1, "import 'a';"), ("c", 2, 'import b from "c";')]),
    ("go", "import \"a\"\nimport (\n\tb \"c/d\"\n\t// \"e\"\n\t`f`\n)\nvar x = \"y\"\n", [("a", 1, '"a"'), ("c/d", 3, 'b "c/d"')]),
    ("rust", "use a::{b, c};\npub use d;\n// use e;\n", [("a::{b, c}", 1, "use a::{b, c};"), ("d", 2, "pub use d;")]),
])
def test_lexical_imports(spark, language, code, wanted):
    assert collect(X.lexical_imports(sources(spark, language, code)), "module", "line", "raw") == wanted


def test_lexical_references(spark):
    composed, decomposed = "\u00e9", "e\u0301"
    src = sources(spark, "python", f"{composed} = '{composed}'  # {composed}\nf({composed})\n", f"x{decomposed} + f")
    names = spark.createDataFrame([(composed,), ("x" + composed,), ("f",)], "name string")
    got = collect(X.lexical_references(src, names), "file_id", "name", "line", "col")
    assert got == sorted([("f0", composed, 1, 1), ("f0", "f", 2, 1), ("f0", composed, 2, 3), ("f1", "x" + composed, 1, 1), ("f1", "f", 1, 7)])


def test_many_headers_in_one_long_line(spark):
    count = 30_000
    code = "".join(f"function f{i}(a){{return g(a)}}" for i in range(count))
    src = sources(spark, "javascript", code)
    found = X.lexical_definitions(src).select("name", "kind", "start_line", "end_line", "name_col").collect()
    assert len(found) == count and {(r.kind, r.start_line, r.end_line) for r in found} == {("function", 1, 1)}
    assert all(code.startswith(r.name + "(", r.name_col) for r in found)
    assert X.lexical_calls(src).groupBy("name").count().collect() == [("g", count)]


def test_columns_are_those_of_the_match_itself(spark):
    pad = " " * 990
    for code in ("fn ab() {} fn a() {}", "fn ab() {}" + pad + " fn a() {}"):
        src = sources(spark, "rust", code)
        assert collect(X.lexical_definitions(src), "name", "name_col") == [("a", code.index("fn a()") + 3), ("ab", 3)]
        assert X.lexical_calls(src).count() == 0
    assert collect(X.lexical_calls(sources(spark, "bash", "a | b | b\n")), "name", "col") == [("a", 0), ("b", 4), ("b", 8)]


ODD = "new A(b) $ $c (d)\n  e // f(\n (g)'h(' i\t(j) `k\nl(` m() 2n() \u00e9 (p)\r\n\U0001F600 q(r)/* s(\n*/t /**/ (u) v"


@pytest.mark.parametrize("language", ["python", "java", "php", "rust", "javascript"])
def test_words_are_read_without_the_other_tokens(spark, language):
    src = sources(spark, language, ODD, ODD.replace("`", '"'), "", "a")
    words = T.tokens(src).filter("kind = 'word'").filter(r"text rlike '^[\\p{L}_$]'").selectExpr("file_id", "text AS word", "row", "col")
    columns = ("file_id", "word", "row", "col")
    assert collect(X._words(src, lambda x: x.to_word), *columns) == collect(words, *columns)
    # words before a parenthesis, as neighbouring tokens show them
    seen = T.tokens(src).filter("kind NOT IN ('space', 'comment')").orderBy("file_id", "pos").collect()
    called = [(a.file_id, a.text, a.row, a.col) for a, b in zip(seen, seen[1:]) if a.kind == "word" and b.text == "("
              and a.file_id == b.file_id and (a.text[0].isalpha() or a.text[0] in "_$")]
    found = X._words(src, lambda x: x.to_call).filter("end_idx < size")
    assert called and collect(found, *columns) == sorted(called)


def test_calls_see_no_neighbouring_tokens(spark):
    src = sources(spark, "java", ODD)
    once, again = once_and_again(src)
    assert (once.count(), again.count()) == (1, 0)
    assert [r[0] for r in collect(X.lexical_calls(src), "name")] == ["$c", "e", "i", "m", "q", "t", "\u00e9"]


def test_files_that_share_an_id_are_read_token_by_token(spark):
    src = sources(spark, "python", "f(\n a)\n", "f(\n a)\n", "g(b)").replace({"f1": "f0"}, subset=["file_id"])
    once, again = once_and_again(src.unionByName(src.filter("file_id = 'f2'").withColumn("file_id", F.lit(None).cast("string"))))
    assert collect(once, "code") == [("g(b)",), ("g(b)",)] and again.count() == 2
    columns = ("file_id", "pos", "kind", "text", "start_idx", "end_idx", "row", "col")
    assert collect(T.tokens(src, blanks=False), *columns) == collect(T.tokens(src).filter("kind <> 'space'"), *columns)
    names = spark.createDataFrame([("a",), ("b",)], "name string")
    words = T.tokens(src).filter("text IN ('a', 'b')").selectExpr("file_id", "text AS name", "row + 1 AS line", "col + 1 AS col")
    found = X.lexical_references(src, names)
    assert set(collect(found, "file_id", "name", "line", "col")) == set(collect(words, "file_id", "name", "line", "col"))
    assert [r[0] for r in collect(X.lexical_calls(src), "name")] == ["f", "g"]


def test_headers_bound_to_the_start_of_a_line():
    bound = {language: [X._anchored(pattern) for _, pattern in rules] for language, rules in X.HEADERS.items()}
    assert bound["python"] == [True, True] and bound["rust"] == [False, False, False, False, True]
    assert bound["php"] == [True] * 4 and all(X._anchored(pattern) for _, pattern in X._GO_MEMBERS)
    assert not X._anchored(r"(^\s*+|[;|]\s*+)(\w++)") and X._anchored(r"(^[(]\(a|)(\w++)") is False
