"""Loading, selection, admission, decoding, languages."""

import os

import pytest
from pyspark.sql import functions as F

from codequarry.sources import files as Fi
from codequarry.sources import sinks
from codequarry.sources.languages import language_capabilities, resolve_language
from codequarry.sources.tree import SourceTree


def paths(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "path string")


def kept(df):
    return sorted(r.path for r in df.collect())


@pytest.mark.parametrize("kwargs", [
    {"patterns": ["a/../b"]}, {"patterns": ["/abs/*.py"]}, {"patterns": ["\\abs"]}, {"excludes": ["!x"]}, {"excludes": [".."]},
])
def test_check_globs_refuses(kwargs):
    with pytest.raises(ValueError):
        Fi.check_globs(**kwargs)


def test_check_globs_allows():
    Fi.check_globs(["!x", "**/*.py"], ["/abs/**"])


@pytest.mark.parametrize("glob, hit, miss", [
    ("**/*.py", ["a.py", "x/y/a.py"], ["a.pyc", "a.py/b"]), ("*.{js,ts}", ["a.js", "b.ts"], ["x/a.js", "a.jsx"]),
    ("src/**", ["src/a", "src/a/b"], ["src", "xsrc/a"]), ("**/tests/**", ["tests/a", "x/tests/a/b"], ["tests", "mytests/a"]),
    ("a?.[ch]", ["ab.c", "ab.h"], ["a/.c", "abc.c"]), ("[!a].go", ["b.go"], ["a.go"]), ("a+b(c).rs", ["a+b(c).rs"], ["aab(c).rs"]),
])
def test_globs(spark, glob, hit, miss):
    df = paths(spark, *hit, *miss).filter(F.col("path").rlike(Fi.glob_regex(glob)))
    assert kept(df) == sorted(hit)


def test_include_paths(spark):
    df = paths(spark, "a.py", "UP.PY", "b.pyi", "c.txt", ".hid/d.py", "e/.f.py", "g", "h.rs", "__init__.py")
    assert kept(Fi.include_paths(df)) == ["__init__.py", "a.py", "b.pyi", "h.rs"]
    assert kept(Fi.include_paths(df, language="py")) == ["__init__.py", "a.py", "b.pyi"]
    assert kept(Fi.include_paths(df, ["*.txt"], "python")) == ["c.txt"]


def test_exclude_paths(spark):
    df = paths(spark, "build/a.js", "builds/a.js", "build", "x/node_modules/y/z.js", "a.min.js", "a.min.jsx", "x/b.map", "t/c.js",
               "out.js", "x/.git/c")
    assert kept(Fi.exclude_paths(df)) == ["a.min.jsx", "build", "builds/a.js", "out.js", "t/c.js"]
    assert kept(Fi.exclude_paths(df, ["**/t/**"])) == ["a.min.jsx", "build", "builds/a.js", "out.js"]


def test_cap_files(spark):
    df = paths(spark, *[f"{i:04}" for i in range(700)])
    assert Fi.cap_files(df).count() == 700
    assert kept(Fi.cap_files(df, 3)) == ["0000", "0001", "0002"]
    assert Fi.cap_files(df, 900).count() == 700


def test_a_dot_pattern_opens_dot_names_for_itself_only(spark):
    df = paths(spark, ".hid/x.py", ".github/a.yml", "b.py", ".github/c.py")
    assert kept(Fi.include_paths(df, ["**/*.py", ".github/*.yml"])) == [".github/a.yml", "b.py"]


@pytest.mark.parametrize("path, given, language", [
    ("a.py", None, "python"), ("A.PY", None, "python"), ("x/.bashrc", None, None), ("x/.a.rb", None, "ruby"), ("noext", None, None),
    ("a.b/c", None, None), ("a.py", "RS", "rust"), ("a.py", "Ruby", "ruby"), ("a.py", "cobol", None), (None, "tsx", "tsx"),
    (None, None, None), ("a.", None, None), ("a.py", "", "python"),
])
def test_detect_language(spark, path, given, language):
    df = spark.createDataFrame([(path, given)], "path string, explicit_language string")
    got = Fi.detect_language(df).first()
    assert got.language == language
    assert (got.language_error is None) == (language is not None)


def test_resolve_language():
    assert resolve_language("YML") == "yaml" and resolve_language("typescript") == "typescript"
    with pytest.raises(ValueError):
        resolve_language("cobol")


def test_language_filter_is_silent_and_first(spark):
    df = spark.createDataFrame([("a.json", 1 << 40, False), ("a.py", 1, False), ("a.xyz", 1, True), ("b.rs", 1 << 40, False)],
                               "path string, length bigint, has_nul boolean")
    assert kept(Fi.language_filter(df)) == ["a.py", "b.rs"]
    assert kept(Fi.language_filter(df, "rust")) == ["b.rs"]
    ok, errors = Fi.admit(Fi.language_filter(df))
    assert kept(ok) == ["a.py"] and kept(errors) == ["b.rs"]
    status = {r.path: (r.scanned, r.error is None) for r in Fi.scan_status(df).collect()}
    assert status == {"a.json": (False, True), "a.py": (True, True), "a.xyz": (False, True), "b.rs": (False, False)}


def test_admit_bytes(spark):
    nul = lambda at: b"x" * at + b"\0" + b"y"
    df = spark.createDataFrame([
        ("ok", bytearray(b"abc")), ("empty", bytearray()), ("nul8191", bytearray(nul(8191))), ("nul8192", bytearray(nul(8192))),
        ("ten", bytearray(10 << 20 and b"z" * (10 << 20))), ("more", bytearray(b"z" * ((10 << 20) + 1))), ("gone", None),
    ], "path string, content binary")
    ok, errors = Fi.admit(df)
    assert kept(ok) == ["empty", "nul8192", "ok", "ten"]
    assert sorted((r.path, r.stage, r.error) for r in errors.collect()) == [
        ("gone", "admit", "read failed"), ("more", "admit", "file too large: 10485761"), ("nul8191", "admit", "binary file: NUL byte")]


@pytest.mark.parametrize("raw", [
    b"\xef\xbb\xbfhi", b"\xef\xbb\xbf\xef\xbb\xbfhi", b"a\xff\xe2\x82b", b"", b"a\rb", "é😀".encode(), b"\xff\xfe", b"x\xef\xbb\xbf",
])
def test_decode_text(spark, raw):
    df = spark.createDataFrame([(bytearray(raw),)], "content binary")
    assert Fi.decode_text(df).first().code == raw.removeprefix(b"\xef\xbb\xbf").decode("utf-8", "replace")


@pytest.fixture
def folder(tmp_path):
    for name, content in {
        "a.py": b"x", "__init__.py": b"y", "empty.py": b"", ".dot.py": b"z", ".hid/b.py": b"z", "sub/c.rs": b"w" * 50,
        "sub/big.rs": b"v" * 200,
    }.items():
        file = tmp_path / name
        file.parent.mkdir(exist_ok=True)
        file.write_bytes(content)
    os.symlink(tmp_path / "a.py", tmp_path / "link.py")
    return str(tmp_path)


def test_source_tree_keeps_all_regular_files(spark, folder):
    spark.dataSource.register(SourceTree)
    df = spark.read.format("source_tree").option("maxPartitionBytes", 60).option("maxFileBytes", 100).load(folder)
    assert {r.path: (r.length, r.content and len(r.content)) for r in df.collect()} == {
        "a.py": (1, 1), "__init__.py": (1, 1), "empty.py": (0, b""), "sub/c.rs": (50, 50), "sub/big.rs": (200, None)}
    assert df.rdd.getNumPartitions() > 1


def test_load_source_tree(spark, folder):
    got = {r.path: r.length for r in Fi.load_source_tree(spark, folder).collect()}
    assert got["a.py"] == 1 and got["sub/c.rs"] == 50


def test_load_sources(spark):
    df = spark.createDataFrame([("f", "x=1", 7)], "file_id string, code string, more int")
    assert Fi.load_sources(df).first().asDict() == {"file_id": "f", "path": None, "language": None, "code": "x=1"}


def test_capabilities(spark):
    rows = {r.language: (r.has_definition_rules, r.has_call_rules, r.has_import_rules) for r in language_capabilities(spark).collect()}
    assert len(rows) == 16 and sum(a for a, _, _ in rows.values()) == 12
    assert rows["go"] == (True, True, True) and rows["php"] == (True, True, False) and rows["css"] == (False, False, False)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("go", 1, "a")], "language string, n int, s string")
    sinks.write_table(df, str(tmp_path / "t"), by=["language"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    assert sinks.report_json(df).first().report == '{"language":"go","n":1,"s":"a"}'


def test_row_wise_operators_take_streams(spark, tmp_path):
    df = spark.createDataFrame([("a.py", bytearray(b"x\ny")), ("b.bin", bytearray(b"\0"))], "path string, content binary")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("path string, content binary").parquet(str(tmp_path / "in"))
    ok, _ = Fi.admit(Fi.include_paths(stream))
    query = (
        Fi.decode_text(Fi.detect_language(ok)).select("path", "language", "code").writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination(60)
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("a.py", "python", "x\ny")]
