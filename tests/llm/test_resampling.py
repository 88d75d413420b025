"""Importance resampling against a plain version."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from codequarry.llm import resampling
from codequarry.llm.resampling import HeadTail, pair_table, resample, word_runs

DOCS, TARGET = "doc_id long, text string, score long, n int", "item_id long, text string"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return WORDS.findall((text or "").translate(LOWER))


def plain(docs, target, percent, least, seed, buckets):
    crc = lambda words: [zlib.crc32(f.encode()) % buckets for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]
    found, wanted = [crc(plain_words(t)) for _, t in docs], [crc(plain_words(t)) for t in target]
    s, t = (np.bincount([b for f in fs for b in f], minlength=buckets) for fs in (found, wanted))
    gain = [math.floor(1000 * math.log((int(y) + 1) * (int(s.sum()) + buckets) / ((int(x) + 1) * (int(t.sum()) + buckets)))) for x, y in zip(s, t)]
    rows = []
    for (i, text), f in zip(docs, found):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(plain_words(text)) >= least))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = able[: len(able) * percent // 100]
    return sorted([(*r[:4], None) for r in rows if not r[4] or r not in drawn] + [(*r[:4], k + 1) for k, r in enumerate(drawn)], key=str)


def some_texts(n, seed):
    rnd = random.Random(seed)
    letters = ["alpha", "Beta", "gamma", "ÉTÉ", "été", "中文", "x" * 70, "y" * 200, "a1", "9", "\x80", "I\u0307"]
    return ["".join(rnd.choice(letters) + rnd.choice([" ", ", ", "\n", "_", "", "\0", "\u00a0"]) for _ in range(rnd.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize(("percent", "heads"), [(25, (1 << 16, 1 << 18)), (100, (6, 5)), (33, (0, 0)), (0, (1 << 16, 0))])
def test_resampling_against_a_plain_version(spark, percent, heads):
    texts = [None, "", "...", "one", *some_texts(150, 3)] + ["same text again and again " * 6] * 30
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, texts[9]), (3, texts[40]), (3, texts[40])]
    target = [None, "", *some_texts(10, 4), "again and again"]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], DOCS).repartition(3)
    got = resample(df, spark.createDataFrame(list(enumerate(target)), TARGET), percent, 5, 11, 100, heads=heads)
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, target, percent, 5, 11, 100)


def test_resampling_of_nothing(spark):
    empty, target = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b")], TARGET)
    assert resample(empty, target).count() == 0
    rows = [(i, f"w{i} " * 20, 0, 0) for i in range(8)]
    got = resample(spark.createDataFrame(rows, DOCS), target.limit(0), 50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4]


@pytest.mark.parametrize("most", [1, 5, 40, 10**6])
def test_words_do_not_depend_on_portions(most):
    texts = [t.encode() if t is not None else None for t in [None, "", "a", *some_texts(40, 5), "z" * 300 + " b c"]]
    words, pairs = [], []
    for portion, owner, again in word_runs(texts, most):
        words += [(int(o), w.decode()) for o, w in zip(owner[again:], portion[again:])]
        pairs += [(int(a), u, v) for a, b, u, v in zip(owner, owner[1:], portion, portion[1:]) if a == b]
    want = [plain_words(t.decode() if t else "") for t in texts]
    assert words == [(i, w) for i, ws in enumerate(want) for w in ws]
    assert [(i, a.decode(), b.decode()) for i, a, b in pairs] == [(i, a, b) for i, ws in enumerate(want) for a, b in zip(ws, ws[1:])]


def test_buckets_of_pairs_stored_and_direct():
    rnd = random.Random(2)
    words = sorted({bytes(rnd.choice(b"abcdef\xc3\xa9") for _ in range(rnd.randrange(1, 64))) for _ in range(300)})
    table = HeadTail(words, 997)
    codes = np.array([rnd.randrange(len(words)) * resampling.HEAD_WORDS + rnd.randrange(len(words)) for _ in range(3000)], np.int64)
    want = [zlib.crc32(words[c // resampling.HEAD_WORDS] + b" " + words[c % resampling.HEAD_WORDS]) % 997 for c in codes.tolist()]
    assert table.buckets_of(codes).tolist() == want
    stored = np.unique(codes[:1500])
    assert HeadTail(words, 997, pair_table(stored, table.buckets_of(stored))).buckets_of(codes).tolist() == want
    assert HeadTail([], 997).buckets_of(codes[:0]).tolist() == []
