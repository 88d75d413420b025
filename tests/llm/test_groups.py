"""Near duplicates, repeated lines and components against brute force."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from codequarry.llm import oracle
from codequarry.llm.components import components
from codequarry.llm.embedding_dedup import embedding_links
from codequarry.llm.line_dedup import drop_repeated_lines
from codequarry.llm.simhash import fingerprint, near_fingerprints, one_of_each, simhash_groups, trie_pairs


def smallest(nodes, edges):
    """The smallest node each node can reach."""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rnd = random.Random(1)
    edges = {"path": [(i, i + 1) for i in range(70)], "star": [(50, i) for i in range(100)], "none": [(3, 3)],
             "random": [(rnd.randrange(-60, 60), rnd.randrange(-60, 60)) for _ in range(50)]}[shape]
    rnd.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges * 2, "a long, b long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == smallest(nodes, [e for e in edges if e[0] != e[1]])


# --- SimHash ------------------------------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprint():
    rnd = random.Random(2)
    for text in ["", " \n", "a", "A b", "É é", *(" ".join(rnd.choice("abcÄd") for _ in range(rnd.randrange(40))) for _ in range(60))]:
        assert fingerprint(text.encode()) == plain_fingerprint(text)


def near(values):
    return {(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2}


def clustered(rng, n, centres):
    out = rng.integers(0, 1 << 63, centres, dtype=np.int64).astype(np.uint64)[rng.integers(0, centres, n)]
    for _ in range(3):
        out = out ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    return np.unique(out)


@pytest.mark.parametrize("centres", [1, 5, 200])
def test_trie_pairs(centres):
    rng = np.random.default_rng(centres)
    values = clustered(rng, 400, centres)
    a, b = trie_pairs(values, values, 0, 2, True)
    got = list(zip(values[a].tolist(), values[b].tolist()))
    assert len(got) == len(set(got)) and set(got) == near(values.tolist())
    left, right = values[::2], values[1::2]
    a, b = trie_pairs(left, right, 0, 2, False)
    want = {(x, y) for x in left.tolist() for y in right.tolist() if (x ^ y).bit_count() <= 2}
    assert set(zip(left[a].tolist(), right[b].tolist())) == want and len(a) == len(want)


@pytest.mark.parametrize("leaf", [4, 40, 10_000])
def test_near_fingerprints_over_leaves_of_uneven_depth(spark, leaf):
    rng = np.random.default_rng(7)
    values = np.unique(np.concatenate([clustered(rng, 250, 2), clustered(rng, 150, 60), np.array([0, 1, 3, 2**64 - 1], np.uint64)]))
    rows = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    got = {(r.a % 2**64, r.b % 2**64) for r in near_fingerprints(rows, 2, leaf).collect()}
    assert {tuple(sorted(p)) for p in got} == near(values.tolist())


def test_simhash_groups_and_survivors(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    texts = [None, "", "  \n"]
    for _ in range(12):
        base = [rnd.choice(words) for _ in range(rnd.choice([4, 60, 3000]))]
        texts += [" ".join(base), " ".join(base).upper(), " ".join([*base[:-1], "end"]), " ".join(base)]
    rows = [(i * 7 % 101, t, "x") for i, t in enumerate(texts)] + [(None, "", "x"), (4, texts[3], "x"), (4, texts[3], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = simhash_groups(docs, leaf=8).collect()
    assert len(got) == len(rows)
    prints = {t: plain_fingerprint(t) for _, t, _ in rows}
    root = smallest(set(prints.values()), near(set(prints.values())))
    least = {}
    for i, t, _ in rows:
        least[root[prints[t]]] = min(least.get(root[prints[t]], 10**9), 10**9 if i is None else i)
    want = sorted((str(i), format(prints[t], "016x"), least[root[prints[t]]]) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    stay = one_of_each(docs, leaf=8).collect()
    assert sorted(r.doc_id for r in stay) == sorted(least.values()) and stay[0].asDict().keys() == {"doc_id", "text", "fingerprint"}


def test_simhash_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_groups(empty).count() == 0 and one_of_each(empty).count() == 0
    nulls = spark.createDataFrame([(None, None), (None, None)], "doc_id long, text string")
    assert [tuple(r) for r in simhash_groups(nulls).collect()] == [(None, "0" * 16, None)] * 2


# --- embeddings ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [16, 64, 100_000])
def test_embedding_links(spark, block):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(9, 6))
    x = centres[rng.integers(0, 9, 260)] + rng.normal(size=(260, 6)) * rng.choice([0.02, 0.15, 0.6], (260, 1))
    x[50:80] = x[49]
    x[90] = x[91] * 1e-200
    x[92] = x[93] * 1e200
    labels = [int(v) for v in rng.integers(0, 2, 260)]
    rows = [(i, [float(v) for v in x[i]], labels[i], "c") for i in range(260)]
    odd = [None, [], [0.0] * 6, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] + [0.0] * 5, [1.0, 2.0], [1.0, 2.0]]
    rows += [(300 + i, v, 0, "c") for i, v in enumerate(odd)] + [(400, rows[49][1], None, "c"), (401, rows[49][1], None, "c")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, kept string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_links(table, 0.93, block=block, pivots=5).collect()}
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    close = (unit @ unit.T >= 0.93) & (np.array(labels)[:, None] == np.array(labels)[None, :])
    pairs = [(a, b) for a in range(260) for b in range(260) if a != b and close[a, b]] + [(306, 307), (307, 306)]
    root = smallest(range(500), pairs)
    links = {i: sum(1 for a, _ in pairs if a == i) for i, *_ in rows}
    assert got == {i: (links[i], root[i], root[i] == i) for i, *_ in rows}


def test_embeddings_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_links(empty).count() == 0
    nulls = spark.createDataFrame([(None, [1.0], 1), (1, None, 1)], "vec_id long, embedding array<float>, label int")
    assert sorted(map(str, embedding_links(nulls).collect())) == sorted(
        map(str, [r for r in embedding_links(nulls).collect()])) and embedding_links(nulls).count() == 2


# --- lines --------------------------------------------------------------------------------------------------------


def plain_lines(docs, min_words):
    """Every pair of places, extended while lines are equal; what a run of enough words repeats goes."""
    lines = {}
    for key, text in docs:
        lines[key] = [(i, x, len(x.encode().split())) for i, x in enumerate(text.split("\n")) if x.encode().split()]
    gone = {k: set() for k in lines}
    order = sorted(lines)
    for d in order:
        for e in [k for k in order if k <= d]:
            for r in range(len(lines[d])):
                for s in range(len(lines[e]) if e != d else r):
                    n = 0
                    while r + n < len(lines[d]) and s + n < len(lines[e]) and lines[d][r + n][1] == lines[e][s + n][1]:
                        n += 1
                    if sum(w for *_, w in lines[d][r : r + n]) >= min_words:
                        gone[d] |= {i for i, *_ in lines[d][r : r + n]}
    return gone


@pytest.mark.parametrize("seed", range(5))
def test_repeated_lines_against_all_pairs(spark, seed):
    rnd = random.Random(seed)
    pool = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(1, [4, 9, 3, 12, 6][seed]))) for _ in range(12)]
    pool += ["", "  ", "\t"]
    docs = []
    for d in range(14):
        body = [rnd.choice(pool) for _ in range(rnd.randrange(0, 22))]
        if docs and rnd.random() < 0.6:
            other = rnd.choice(docs)[1].split("\n")
            at = rnd.randrange(len(other))
            body[len(body) // 2 : len(body) // 2] = other[at : at + rnd.randrange(1, 8)]
        docs.append((d, "\n".join(body)))
    gone = plain_lines(docs, 10)
    shuffled = [(d, t, "x") for d, t in docs]
    rnd.shuffle(shuffled)
    rows = drop_repeated_lines(spark.createDataFrame(shuffled, "doc_id long, text string, clean string"), 10).collect()
    for r in rows:
        lines = r.doc.text.split("\n")
        assert r.clean == "\n".join(x for i, x in enumerate(lines) if i not in gone[r.doc.doc_id]), (seed, r)
        assert (r.n_lines, r.n_removed) == (len(lines), len(gone[r.doc.doc_id]))
    documents = pd.DataFrame(docs, columns=["doc_id", "text"])  # noqa: F841  read by DuckDB
    table = duckdb.connect().execute(oracle.line_dedup("documents", 10)).fetchall()
    assert {r[0]: r[3] for r in table} == {r.doc.doc_id: r.clean for r in rows}


def test_repeated_lines_of_odd_rows(spark):
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(1, long), (1, long), (2, None), (3, ""), (4, f"own\n{long}\n\nend"), (None, f"{long}\ntail"), (5, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc.doc_id or 0), r.n_lines, r.n_removed, str(r.clean)) for r in drop_repeated_lines(docs).collect())
    assert got == [(0, 2, 0, f"{long}\ntail"), (1, 1, 1, ""), (1, 1, 1, ""), (2, 0, 0, "None"), (3, 1, 0, ""),
                   (4, 4, 1, "own\n\nend"), (5, 1, 1, "")]
    assert drop_repeated_lines(docs.limit(0)).count() == 0


def test_a_passage_in_every_document_goes_but_once(spark):
    passage = "\n".join(" ".join(f"p{i}w{k}" for k in range(9)) for i in range(7))
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("own "), F.col("id").cast("string"), F.lit("\n" + passage)).alias("text"))
    rows = drop_repeated_lines(docs).groupBy("n_removed").count().collect()
    assert sorted(map(tuple, rows)) == [(0, 1), (7, 399)]
