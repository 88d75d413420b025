"""The pipeline, stage by stage against brute force, and the registered queries against their SQL."""

from __future__ import annotations

import base64
import hashlib
import importlib.util
import math
import os
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from codequarry.llm import queries
from tests.llm.test_groups import near, plain_fingerprint, plain_lines, smallest
from tests.llm.test_rows import plain_targets
from tests.llm.test_tokens import plain_measures

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The rows before the first stage and after each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [[r.asDict() for r in docs.collect()]]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        out.append([r.asDict() for r in docs.collect()])
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    return out


def test_every_stage_but_the_last_returns_documents(stages):
    assert [list(rows[0]) for rows in stages[:5]] == [COLUMNS] * 5


def plain_kept(r):
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(queries.vocabularies()["en" if r["lang"] == "en" else None], "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    by_rank = {b: a for a, b in table.items()}
    ids = encoding.encode_ordinary(r["text"])
    band = queries.BANDS.get(r["lang"], queries.BANDS[None])
    words, *_, repeated = plain_measures(r["text"])
    entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in Counter(ids).values())
    broken = sum("�" in by_rank[t].decode("utf-8", "replace") for t in ids) / len(ids)
    return words >= 50 and repeated * 2 <= words and band.min_chars <= len(r["text"]) / len(ids) <= band.max_chars and \
        broken <= band.max_fallback and entropy >= min(band.min_entropy, band.min_evenness * math.log2(len(ids)))


def test_quality_stage(stages):
    some = stages[0][:60]
    kept = {r["doc_id"] for r in stages[1]}
    assert [r["doc_id"] in kept for r in some] == [plain_kept(r) for r in some]
    before = {r["doc_id"]: r for r in stages[0]}
    assert all(before[r["doc_id"]] == r for r in stages[1])


def test_line_stage(stages):
    gone = plain_lines([(r["doc_id"], r["text"]) for r in stages[1]], 50)
    want = {r["doc_id"]: "\n".join(x for i, x in enumerate(r["text"].split("\n")) if i not in gone[r["doc_id"]]) for r in stages[1]}
    assert {r["doc_id"]: r["text"] for r in stages[2]} == want and len(stages[2]) == len(want)
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2])


def test_simhash_stage(stages):
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in stages[2]}
    root = smallest(set(prints.values()), near(set(prints.values())))
    least = {}
    for d, f in prints.items():
        least[root[f]] = min(d, least.get(root[f], d))
    assert sorted(r["doc_id"] for r in stages[3]) == sorted(least.values())


def test_mix_stage(stages):
    size = {r["doc_id"]: len(r["text"].split()) for r in stages[3]}
    source = {r["doc_id"]: r["source"] for r in stages[3]}
    totals, taken = Counter(), Counter()
    for d, n in size.items():
        totals[source[d]] += n
    copies = Counter(r["doc_id"] for r in stages[4])
    for d, n in copies.items():
        taken[source[d]] += n * size[d]
    assert max(copies.values()) <= 3 and set(copies) <= set(size)
    for s, t in plain_targets(totals).items():
        assert abs(taken[s] - t) <= max(2, 0.02 * t), (s, t, taken[s])


def test_bpe_stage(stages):
    library = Tokenizer.from_file(public_tokenizers.path(queries.VOCABULARY))
    want = []
    for r in stages[4]:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest()))
    assert sorted(tuple(r.values()) for r in stages[5]) == sorted(want)


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(map(tuple, rows)) == sorted(tuple(r.values()) for r in stages[5])


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_equals_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{sf_dir}/{file}'")
    got = connection.execute(queries.CHECKS[name])
    names = sorted(d[0] for d in got.description)
    order = [[d[0] for d in got.description].index(n) for n in names]
    want = [tuple(row[i] for i in order) for row in got.fetchall()]
    df = queries.QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == names
    assert sorted(map(str, map(tuple, df.select(*names).collect()))) == sorted(map(str, want))


def test_nothing_else_imports_this_subpackage():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, files in os.walk(os.path.join(root, "codequarry")):
        if not folder.endswith("llm"):
            for f in files:
                if f.endswith(".py"):
                    assert "codequarry.llm" not in open(os.path.join(folder, f)).read(), f
    assert importlib.util.find_spec("__spark_entry__")
