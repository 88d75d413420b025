"""Encoding by ranks over stitched chunks against the public library."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from codequarry.llm import queries
from codequarry.llm.rank_bpe import Ranks, rank_decode, rank_encode

PATH, PATTERN = public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN
LETTERS = "abcdeé ñ\n\t  中文😀'stvellre 0123.,;!? \u200b\0\r"
SPECIAL = [None, "", "   ", " \n a", "<|endoftext|>", "a" * 900, "ab" * 700, "\n\n\na", " " * 400 + "x", "don't I'll we're", "'" * 300 + "ll", "0" * 500,
           "a b " * 300, "中" * 300, "😀 " * 200, "x'll" * 150, " \t" * 300 + "'s"]


@pytest.fixture(scope="module")
def ranks():
    return Ranks(open(PATH, "rb").read())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks.rank, special_tokens={})


def texts(n, longest, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(LETTERS) for _ in range(rnd.randrange(longest))) for _ in range(n)]


def test_pieces_have_the_ids_of_the_library(ranks, library):
    rnd = random.Random(1)
    pieces = ["", *("".join(rnd.choice("abcdefghijklmnopqrstuvwxyzé中 0123\0") for _ in range(rnd.randrange(1, 90))) for _ in range(4000)), "a" * 64, "ab" * 500]
    flat, lengths = ranks.many(pieces)
    ends = np.cumsum(lengths)
    for p, n, end in zip(pieces, lengths, ends):
        want = library._encode_single_piece(p.encode()) if p else []
        assert flat[end - n : end].tolist() == want, p
        assert not p or ranks.ids_of(p.encode()) == want


@pytest.mark.parametrize(("chunk", "overlap"), [(40, 8), (100, 30), (33, 32), (1 << 15, 512)])
def test_ids_do_not_depend_on_chunks(spark, library, chunk, overlap):
    values = [*SPECIAL, *texts(60, 600, 2)]
    rows = [(i, t, "x", 7) for i, t in enumerate(values)] + [(None, values[8], "x", 7), (8, values[8], "x", 7)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string, bytes int")
    encoded = rank_encode(docs, PATH, PATTERN, chunk=chunk, overlap=overlap)
    assert encoded.columns == ["doc_id", "digest", "bytes", "ids"]
    got = rank_decode(encoded, PATH, data="raw").collect()
    want = [(i, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t, *_ in rows]
    assert sorted(str((r.doc_id, bytes(r.ids), bytes(r.raw))) for r in got) == sorted(map(str, want))


def test_one_piece_longer_than_many_chunks(spark, library):
    values = ["start " + "a" * 3000 + " end " + "b c " * 200, "   " * 1000 + "tail", "!" * 5000]
    docs = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")
    got = {r.doc_id: bytes(r.ids) for r in rank_encode(docs, PATH, PATTERN, chunk=64, overlap=16).collect()}
    assert got == {i: np.array(library.encode_ordinary(t), "<u4").tobytes() for i, t in enumerate(values)}


def test_nothing_and_odd_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert rank_encode(empty, PATH, PATTERN).count() == 0
    odd = spark.createDataFrame([(1, None), (2, b""), (3, bytes([255, 255, 255, 255])), (4, bytes([0, 0, 0, 0, 1]))], "n int, ids binary")
    assert [bytes(r.bytes) for r in rank_decode(odd, PATH).orderBy("n").collect()] == [b"", b"", b"", b"!"]
    with pytest.raises(ValueError):
        rank_encode(empty, PATH, PATTERN, chunk=10, overlap=10)
