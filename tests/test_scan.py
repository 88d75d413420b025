"""One scan from bytes: all its tables speak of the same files."""

from __future__ import annotations

import pytest

from codequarry.operators.scan import scan
from tests.helpers import leaf, n, tables

PY = b"def f(q):\n    return g(q)\n\nclass K:\n    pass\n"
FILES = [
    ("a/f.py", PY), ("a/empty.py", b""), ("a/bom.py", b"\xef\xbb\xbfdef h(): pass\n"), ("a/nul.py", b"def x(): pass\x00"),
    ("a/none.py", None), ("a/big.py", b"#" * 50), ("a/data.json", b"{}"), ("a/read.me", b"x"), (".hid/f.py", PY),
    ("node_modules/f.py", PY), ("b/m.js", b"function run(q) { return 1; }\n"), (None, PY),
]


@pytest.fixture(scope="module")
def files(spark):
    return spark.createDataFrame(FILES, "path string, content binary")


def test_all_tables_speak_of_the_selected_files(files):
    got = scan(files, max_bytes=49)
    totals = {r.path: (r.language, r.scanned, r.error, r.total) for r in got.file_totals().collect()}
    assert totals == {
        "a/f.py": ("python", True, None, 2), "a/empty.py": ("python", True, None, 0), "a/bom.py": ("python", True, None, 1),
        "a/nul.py": ("python", False, "binary file: NUL byte", None), "a/none.py": ("python", False, "read failed", None),
        "a/big.py": ("python", False, "file too large: 50", None), "a/data.json": ("json", False, None, None),
        "b/m.js": ("javascript", True, None, 1),
    }
    s = got.summary(reported=3, listed_errors=3).first()
    assert (s.files_matched, s.files_scanned, s.files_truncated, s.total_definitions, s.n_errors, s.errors_truncated) == (8, 4, True, 4, 3, False)
    assert {(r.path, r.stage) for r in got.errors().collect()} == {("a/nul.py", "admit"), ("a/none.py", "admit"), ("a/big.py", "admit")}
    assert {(r.language, r.n_definitions) for r in got.by_language().collect()} == {("python", 3), ("javascript", 1)}
    reports = {r.path: r for r in got.reports().collect()}
    assert [(d.kind, d.name, d.line, d.signature) for d in reports["a/f.py"].definitions] == [
        ("function", "f", 1, "def f(q):"), ("class", "K", 4, "class K:")]
    assert set(reports) == {"a/f.py", "a/empty.py", "a/bom.py", "b/m.js"} and reports["a/empty.py"].definitions is None


def test_scan_options(files):
    paths = lambda got: {r.path for r in got.matched.collect()}
    assert paths(scan(files, language="javascript")) == {"b/m.js"}
    assert paths(scan(files, patterns=["**/*.py"], exclude=["**/b*"])) == {"a/f.py", "a/empty.py", "a/nul.py", "a/none.py"}
    assert paths(scan(files, max_files=2)) == {"a/big.py", "a/bom.py"}
    assert scan(files.limit(0)).summary().first().files_matched == 0
    only = scan(files, patterns=["a/big.py"], max_bytes=None)
    assert only.summary().first().files_scanned == 1


def test_scan_keeps_what_it_read(spark, files, tmp_path):
    kept = []

    def keep(name, df):
        kept.append(name)
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    got = scan(files, keep=keep)
    assert kept == ["scan_files", "scan_definitions"]
    assert "binaryFile" not in got.summary()._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in got.file_totals().collect()} == {tuple(r) for r in scan(files).file_totals().collect()}


def test_scan_over_nodes(spark):
    nodes, src = tables(spark, ("python", [n("function_definition", leaf("def", "def"), leaf("identifier", "f", "name"))]),
                        ("python", [n("function_definition", leaf("def", "def"), leaf("identifier", "g", "name"))]))
    files = src.selectExpr("file_id", "if(file_id = 'f0', 'x/f.py', 'build/g.py') AS path", "encode(code, 'UTF-8') AS content",
                           "'clash' AS language", "'clash' AS code", "true AS scanned", "'clash' AS explicit_language")
    got = scan(files, nodes=nodes)
    assert [(r.file_id, r.name) for r in got.definitions.collect()] == [("f0", "f")]
    assert [(r.language, r.total) for r in got.file_totals().collect()] == [("python", 1)]
