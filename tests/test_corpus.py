"""The corpus lies by file, so that work on it shuffles no nodes."""

import pytest
from pyspark.sql import functions as F

from codequarry.operators.definitions import definitions
from codequarry.operators.lines import signature
from codequarry.operators.matching import rule_candidates
from codequarry.plans import shared
from codequarry.plans.corpus import FILE_STEP, _blocks, corpus, file_buckets, file_table
from codequarry.plans.queries import QUERIES, candidates
from codequarry.sources.rules import RULES


def _tables(spark, folder):
    """Three suppliers, one of them with an empty file; one pair comes twice."""
    pairs = [(s, p) for s in (1, 2, 9) for p in (3, 7, 300, 301)] + [(1, 3)]
    spark.createDataFrame(pairs, "l_suppkey bigint, l_partkey bigint").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(s, s) for s in (1, 2, 9)], "s_suppkey bigint, s_nationkey int").write.parquet(f"{folder}/supplier.parquet")
    spark.createDataFrame([(p, p % 50) for p in (3, 7, 300, 301)], "p_partkey bigint, p_size int").write.parquet(f"{folder}/part.parquet")
    return str(folder)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_corpus_work_shuffles_no_nodes(spark, tmp_path):
    folder = _tables(spark, tmp_path)
    data, found = corpus(spark, folder), candidates(spark, folder)
    was = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for c, v in zip(was, ("-1", "false")):
            spark.conf.set(c, v)
        parents = data.nodes.select("file_id", F.col("pre").alias("parent"), F.col("type").alias("above"))
        assert "Exchange hashpartitioning" not in _plan(data.nodes.join(parents, ["file_id", "parent"]))
        assert "Exchange hashpartitioning" not in _plan(signature(definitions(found), data.sources))
    finally:
        for c, v in was.items():
            spark.conf.set(c, v)


@pytest.mark.parametrize("name", ["tree_sexp", "node_at"])
def test_queries_over_nodes_shuffle_nothing(spark, tmp_path, name):
    folder = _tables(spark, tmp_path)
    was = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    lines = [(s, p, 0.5, 8.0) for s in (1, 2) for p in (3, 7, 300)]
    spark.createDataFrame(lines, "l_suppkey bigint, l_partkey bigint, l_discount double, l_quantity double").write.mode(
        "overwrite").parquet(f"{folder}/lineitem.parquet")
    try:
        for c, v in zip(was, ("-1", "false")):
            spark.conf.set(c, v)
        assert "Exchange hashpartitioning" not in _plan(QUERIES[name](spark, folder))
    finally:
        for c, v in was.items():
            spark.conf.set(c, v)


def test_corpus_rows_by_file(spark, tmp_path):
    folder = _tables(spark, tmp_path)
    data = corpus(spark, folder)
    files = {r.file_id: r.path for r in data.files.collect()}
    assert len(files) == 7 and data.files.count() == 7
    assert sum("999999999" in path for path in files.values()) == 1
    # whole files: nodes count from 0 on, the root's last descendant is the last node, texts end where roots end
    nodes = data.nodes.groupBy("file_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("pre").alias("low"), F.max("pre").alias("high"),
        F.max(F.when(F.col("pre") == 0, F.col("last_desc"))).alias("last"), F.max(F.when(F.col("pre") == 0, F.col("end_idx"))).alias("end"))
    rows = nodes.join(data.sources, "file_id").collect()
    assert {r.file_id for r in rows} == set(files)
    assert all((r.low, r.high, r.last, r.end) == (0, r.n - 1, r.n - 1, len(r.code)) for r in rows)
    # a pair that comes twice is one block
    code = {r.file_id: r.code for r in rows}[FILE_STEP]
    assert code.count("n_000000000003") == 1


def test_bucket_size_does_not_grow(spark, tmp_path, monkeypatch):
    from codequarry.plans import corpus as plans

    folder = _tables(spark, tmp_path)
    monkeypatch.setattr(plans, "LINES_PER_BUCKET", 1)
    monkeypatch.setattr(plans, "_BUCKETS", {})
    assert file_buckets(spark, folder) == 13
    monkeypatch.setattr(plans, "_BUCKETS", {})
    monkeypatch.setattr(plans, "MOST_BUCKETS", 5)
    assert file_buckets(spark, folder) == 5


def _stored(folder):
    return {name for _, place, name in shared._WRITTEN if place == folder}


def test_tables_are_written_when_asked_for(spark, tmp_path):
    folder = _tables(spark, tmp_path)
    assert QUERIES["capabilities"](spark, folder).agg(F.sum("n_files")).first()[0] == 7
    assert _stored(folder) == {"files"}
    assert QUERIES["lexical_definitions"](spark, folder).count() > 0
    assert _stored(folder) == {"files", "blocks", "sources"}


def test_parts_are_placed_once(spark, tmp_path):
    folder = _tables(spark, tmp_path)
    blocks = _blocks(spark, folder)
    was = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert _plan(blocks).count("REPARTITION_BY_NUM") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    rows = blocks.groupBy("file_id").agg(F.count_if(F.col("variant") == 0).alias("heads"), F.count(F.lit(1)).alias("n")).collect()
    assert sorted((r.heads, r.n) for r in rows) == [(1, 3)] * 6


def test_sizes_of_blocks_are_not_shuffled(spark, tmp_path):
    folder = _tables(spark, tmp_path)
    plan = _blocks(spark, folder)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    first = max(i for i, line in enumerate(plan) if "RepartitionByExpression" in line)
    assert "l_partkey" in plan[first + 1] and "n_nodes" not in plan[first + 1] and sum("Window [" in line for line in plan) == 1


def test_stored_buckets_are_not_sorted(spark, tmp_path, monkeypatch):
    folder = _tables(spark, tmp_path)
    seen = []
    monkeypatch.setattr(spark.conf.__class__, "set", lambda self, key, value, was=spark.conf.__class__.set: (seen.append((key, value)), was(self, key, value))[1])
    file_table(spark, folder, "files", lambda s, d: s.range(3).withColumnRenamed("id", "file_id"))
    own = [v for k, v in seen if k == "spark.sql.maxConcurrentOutputFileWriters"]
    assert own == ["4", "0"]   # for this write alone


def test_candidates_of_bounded_nodes_are_hashed(spark, tmp_path):
    folder = _tables(spark, tmp_path)
    found = candidates(spark, folder)
    assert file_table(spark, folder, "rule_candidates", None).count() == found.count()
    assert 0 < file_table(spark, folder, "inner_candidates", None).count() < found.count()
    nodes, was = corpus(spark, folder).nodes, {
        c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for c, v in zip(was, ("-1", "false")):
            spark.conf.set(c, v)
        sorted_, hashed = (rule_candidates(nodes, RULES, bounded) for bounded in (False, True))
        assert "SortMergeJoin" in _plan(sorted_) and "SortMergeJoin" not in _plan(hashed)
        assert sorted_.exceptAll(hashed).count() == hashed.exceptAll(sorted_).count() == 0
    finally:
        for c, v in was.items():
            spark.conf.set(c, v)


def test_blocks_of_unknown_words_have_no_text(spark, tmp_path):
    folder = _tables(spark, tmp_path)
    spark.createDataFrame([(3, 3), (7, None), (300, None)], "p_partkey bigint, p_size int").write.mode("overwrite").parquet(f"{folder}/part.parquet")
    nodes = corpus(spark, folder).nodes.filter(F.col("file_id") == FILE_STEP).orderBy("pre").collect()
    first = min(r.pre for r in nodes if r.leaf_text == "n_000000000003")
    leaves = [r for r in nodes if r.pre > first and r.last_desc == r.pre]
    texts = [r.leaf_text for r in leaves]
    assert "n_000000000007" not in texts and texts[-1] is None and texts.count(None) > 5
    assert {r.leaf_text for r in corpus(spark, folder).nodes.filter(F.col("file_id") == FILE_STEP + 1).filter("parent > 0").collect()} >= {None}


def test_nodes_are_made_where_they_are_read(spark, tmp_path):
    folder = _tables(spark, tmp_path)
    nodes = corpus(spark, folder).nodes
    assert candidates(spark, folder).count() > 0
    assert _stored(folder) == {"files", "blocks", "placed", "sources", "rule_candidates", "inner_candidates"}
    # roots are there, also those of files without blocks and of files whose part is not known
    roots = {r.file_id: (r.language, r.last_desc, r.parent, r.child_ix) for r in nodes.filter("pre = 0").collect()}
    assert len(roots) == 7 and roots[9 * FILE_STEP + FILE_STEP - 1][1:] == (0, None, 0)
    assert nodes.filter("parent IS NULL").count() == 7
    # each template has its own number, and filters on the type reach the templates
    from codequarry.plans.corpus import template_numbers, template_sizes
    numbers = template_numbers()
    assert len(set(numbers.values())) == len(numbers) == len(template_sizes()) and 0 not in numbers.values()
    assert all(numbers[language, variant] == numbers[language, 0] + variant for language, variant in numbers)
    asked = nodes.filter("type = 'identifier'").select("file_id", "pre")
    read = _plan(asked)
    assert "Union" not in read and "identifier" in read.partition("BroadcastExchange")[2]
