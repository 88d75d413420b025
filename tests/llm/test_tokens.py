"""BPE, chunked encoding, quality measures and token files against the public libraries and plain versions."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from codequarry.llm import queries
from codequarry.llm.bpe import ByteBPE, bpe_decode, bpe_encode
from codequarry.llm.chunks import ChunkEncoder
from codequarry.llm.quality import Band, base_measures, with_quality
from codequarry.llm.repair import Block, compress, expand, expansion_lengths, frequent_pairs, read_token_files, write_block, write_token_files
from codequarry.llm.shared import work_folder

PATH = public_tokenizers.path(queries.VOCABULARY)
LETTERS = "abcdeé ñ\n\t  中文😀'stvellre 0123.,;!? ​\0\r"
SPECIAL = [None, "", "   ", " \n a", "<|endoftext|>", "a<|endoftext|> b <|endoftext|>\n", "a" * 5000, "ab" * 3000, "\n\n\na",
           "a\t \tb", "a   b  c ", "the  the", "a \n b", " ", "\n", "don't I'll we're", "  x", "The cat.\nThe cat."]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def bpe():
    return ByteBPE(open(PATH, encoding="utf-8").read())


def texts(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(LETTERS) for _ in range(rnd.randrange(60))) for _ in range(n)]


def documents(spark, values):
    rows = [(i, v, "src", "en") for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")


def test_prefix_tables_give_the_ids_of_the_library(bpe, library):
    for t in [x or "" for x in SPECIAL] + texts(1500):
        assert bpe.encode(t) == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_prefix_tables_give_the_ids_of_merging_by_the_definition(bpe):
    rnd = random.Random(5)
    for _ in range(300):
        word = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rnd.randrange(1, 25)))
        assert [bpe.ids[r] for r in bpe.merged(word.encode())] == list(bpe.piece(word))


def test_every_token_is_its_own_encoding_or_never_used(bpe):
    for token in range(256, 2000):
        assert bpe._is_whole(token) == (bpe.merged(bpe.bytes[token]) == [token])


@pytest.mark.parametrize("bound", [1, 3, 40, 100_000])
def test_chunk_memory_never_changes_ids(bpe, library, bound):
    encoder = ChunkEncoder(lambda chunks: [bpe.encode(c) for c in chunks], bpe.special, bound)
    values = [x or "" for x in SPECIAL] + texts(400, 2)
    for first in range(0, len(values), 37):
        some = values[first : first + 37]
        ids, counts = encoder.encode(some)
        ends = np.cumsum(counts)
        for t, end, n in zip(some, ends, counts):
            assert ids[end - n : end].tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_encode_and_decode_documents(spark, library):
    values = SPECIAL + texts(200, 3)
    docs = documents(spark, values).withColumn("ids", F.lit("a column of that name"))
    rows = bpe_decode(bpe_encode(docs, PATH), PATH).collect()
    assert len(rows) == len(values)
    for r in rows:
        want = library.encode(values[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == want and r.source == "src"
        assert r.text == library.decode(want, skip_special_tokens=False)
    digests = {r.doc_id: r for r in queries.bpe_digests(bpe_encode(docs.select("doc_id", "text"), PATH), PATH).collect()}
    for i, v in enumerate(values):
        want = library.encode(v or "", add_special_tokens=False).ids
        assert digests[i].n_tokens == len(want)
        assert digests[i].ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256((v or "").encode()).hexdigest()


def test_decode_of_odd_ids(spark):
    rows = spark.createDataFrame([(1, [72, -5, 999_999, 72]), (2, None), (3, [])], "doc_id int, ids array<int>")
    got = {r.doc_id: r.text for r in bpe_decode(rows, PATH).collect()}
    assert got[2] == got[3] == "" and got[1] == got[1][:1] * 2


def test_bpe_of_no_documents(spark):
    empty = documents(spark, []).limit(0)
    assert bpe_decode(bpe_encode(empty, PATH), PATH).count() == 0


# --- quality ------------------------------------------------------------------------------------------------------


def plain_measures(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), again, len(inside)


def test_base_measures_against_a_plain_version():
    rnd = random.Random(3)
    values = ["", " ", "\n\n", "a b c a b c", "a a a a a", "é é é\né é é\n\n é", "x\x0by\x0cz\x1cw v", "#a|b<>&%$*\n#a|b<>&%$*"]
    values += [" ".join(rnd.choice(["a", "b", "c", "dé", "#", "\n", "e\nf"]) for _ in range(rnd.randrange(80))) for _ in range(300)]
    for v in values:
        assert base_measures(v.encode()) == plain_measures(v), repr(v)


def ranks(name):
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(name), "rb"))}


def test_fertility_against_the_library_itself(spark):
    rnd = random.Random(4)
    values = [" ".join(rnd.choice(["the", "house", "wäre", "élan", "中", "x1", "runs"]) for _ in range(rnd.randrange(45, 120))) for _ in range(60)]
    rows = [(i, v, ["en", "de", None, "xx"][i % 4]) for i, v in enumerate(values)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    bands = {"en": Band(2.5, 3.5, 0.05, 1.0, 0.1), None: Band(2.0, 3.4, 0.2, 1.0, 0.1)}
    got = {r.doc.doc_id: r.quality for r in with_quality(docs, queries.vocabularies(), bands).collect()}
    for i, v, lang in rows:
        table = ranks(queries.VOCABULARIES["en" if lang == "en" else None])
        by_rank = {b: a for a, b in table.items()}
        ids = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary(v)
        broken = sum("�" in by_rank[t].decode("utf-8", "replace") for t in ids)
        entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in Counter(ids).values())
        q = got[i]
        assert (q.n_tokens, q.n_words) == (len(ids), len(v.split()))
        assert q.chars_per_token == pytest.approx(len(v) / len(ids)) and q.fallback_share == pytest.approx(broken / len(ids))
        assert q.token_entropy == pytest.approx(entropy)
        band = bands["en" if lang == "en" else None]
        fine = band.min_chars <= len(v) / len(ids) <= band.max_chars and broken / len(ids) <= band.max_fallback
        fine = fine and entropy >= min(band.min_entropy, band.min_evenness * math.log2(len(ids)))
        assert q.kept == (fine and not q.base_failed)
    assert {q.kept for q in got.values()} == {True, False}


def test_quality_of_odd_rows(spark):
    words = " ".join(f"word{i}" for i in range(60))
    rows = [(None, None, None, 1), (1, "", "en", 2), (2, words, "en", 3), (2, words, "en", 3), (3, "a " * 200, "en", 4), (4, words, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept int")
    got = with_quality(docs, queries.vocabularies(), queries.BANDS)
    out = sorted((r.doc.kept, r.quality.base_failed, r.quality.kept) for r in got.collect())
    assert out == [(1, True, False), (2, True, False), (3, False, True), (3, False, True), (4, True, False), (5, False, True)]
    assert with_quality(docs.limit(0), queries.vocabularies(), queries.BANDS).count() == 0


def noisy(text, kind, rnd):
    if kind == "symbols":
        return " ".join(w + rnd.choice(["$$$", "%%%", "&&&", "***", "###"]) for w in text.split())
    return " ".join(w.upper() + "!!" for w in text.split())


def test_noise_is_rejected_in_every_language(spark, sf_dir):
    rnd = random.Random(11)
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()]
    whole = with_quality(spark.createDataFrame(docs, "doc_id long, text string, lang string"), queries.vocabularies(), queries.BANDS)
    clean = [(r.doc.text, r.doc.lang) for r in whole.filter("quality.kept").collect() if len(r.doc.text.split()) < 2000]
    assert {lang for _, lang in clean} == {"en", "de", "fr", "es"}
    rows = [(noisy(t, kind, rnd), lang, kind) for t, lang in clean for kind in ("symbols", "shouting")]
    rows += [(t, lang, "clean") for t, lang in clean] + [(t, None, "clean") for t, _ in clean]
    rows += [(noisy(t, "symbols", rnd), None, "symbols") for t, _ in clean]
    table = spark.createDataFrame(rows, "text string, lang string, kind string")
    got = Counter()
    for r in with_quality(table, queries.vocabularies(), queries.BANDS, scripts=queries.SCRIPT_BANDS).collect():
        got[r.doc.kind, r.doc.lang, r.quality.kept] += 1
    for lang in ("en", "de", "fr", "es", None):
        assert got["symbols", lang, True] == 0 and got["symbols", lang, False] > 0, got
        assert got["clean", lang, False] <= 0.01 * got["clean", lang, True], got
    for lang in ("en", "de", "fr", "es"):
        assert got["shouting", lang, True] <= 0.1 * got["shouting", lang, False], got


SENTENCES = {
    "pl": "Komitet zebrał się w czwartek, aby omówić proponowane zmiany w budżecie regionalnym, a kilku członków twierdziło, że szkoły powinny otrzymać więcej pieniędzy przed budową nowych dróg.",
    "ru": "Комитет собрался в четверг, чтобы обсудить предложенные изменения в региональном бюджете, и несколько членов заявили, что школы должны получить больше денег.",
    "el": "Η επιτροπή συνεδρίασε την Πέμπτη για να συζητήσει τις προτεινόμενες αλλαγές στον περιφερειακό προϋπολογισμό, και αρκετά μέλη υποστήριξαν ότι τα σχολεία πρέπει να λάβουν περισσότερα χρήματα.",
    "ko": "위원회는 목요일에 모여 지역 예산에 대한 변경 제안을 논의했으며 여러 위원은 새 도로를 건설하기 전에 학교가 더 많은 돈을 받아야 한다고 주장했다.",
    "ar": "اجتمعت اللجنة يوم الخميس لمناقشة التغييرات المقترحة على الميزانية الإقليمية، وقال العديد من الأعضاء إن المدارس يجب أن تحصل على مزيد من الأموال.",
    "hi": "समिति ने गुरुवार को क्षेत्रीय बजट में प्रस्तावित बदलावों पर चर्चा करने के लिए बैठक की, और कई सदस्यों ने कहा कि स्कूलों को अधिक पैसा मिलना चाहिए।",
}


def test_other_languages_by_script(spark):
    rnd = random.Random(12)
    alphabets = {"lower": "abcdefghijklmnopqrstuvwxyz", "alnum": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
                 "digits": "0123456789", "signs": "#*$%&|<>", "ru": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "ko": [chr(c) for c in range(0xAC00, 0xD7A3)]}
    rows = [(f"noise {k}", " ".join("".join(rnd.choice(a) for _ in range(rnd.randrange(2, 10))) for _ in range(300))) for k, a in alphabets.items()]
    for k, sentence in SENTENCES.items():
        words = sentence.split()
        mixed = " ".join(" ".join(rnd.sample(words, len(words))) for _ in range(5))
        rows += [(f"text {k}", mixed), (f"noise symbols {k}", noisy(mixed, "symbols", rnd))]
    rows = [(*r, lang) for r in rows for lang in (None, "xx")]
    table = spark.createDataFrame(rows, "name string, text string, lang string")
    out = with_quality(table, queries.vocabularies(), queries.BANDS, scripts=queries.SCRIPT_BANDS).collect()
    assert len(out) == len(rows) and not any(r.quality.base_failed for r in out)
    assert [r.doc.name for r in out if r.quality.kept != r.doc.name.startswith("text")] == []


# --- token files --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(6))
def test_repair_round_trip_and_random_access(seed):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 400, 60)
    ids = np.minimum(rng.zipf(1.5, counts.sum()), [3, 50, 50256, 2, 1, 9][seed]).astype(np.int32)
    pairs, sequence, lengths = compress(ids, counts, least=3)
    first = int(ids.max()) + 1
    sizes = expansion_lengths(pairs, first)
    assert (expand(sequence, pairs, first, sizes) == ids).all() and lengths.sum() == len(sequence)
    owner = np.repeat(np.arange(len(counts)), lengths)
    left = np.stack([sequence[:-1], sequence[1:]])[:, owner[1:] == owner[:-1]]
    assert not left.size or np.unique(left, axis=1, return_counts=True)[1].max() < 3  # nothing frequent is left
    for k, pair in enumerate(pairs.tolist()):
        assert max(pair) < first + k
    block, ends = Block(write_block(ids, counts)), np.cumsum(counts)
    for k in rng.integers(0, len(counts), 20):
        assert (block.document(k) == ids[ends[k] - counts[k] : ends[k]]).all()
    assert (block.all() == ids).all()
    if seed == 4:
        assert len(sequence) < len(ids) / 4  # long runs of one id fold up


@pytest.mark.parametrize("least", [2, 5, 40])
def test_frequent_pairs_share_slots_without_loss(least):
    rng = np.random.default_rng(least)
    left, right = (rng.integers(0, 3000, 200_000) ** 2 // 9000).astype(np.uint32), rng.integers(0, 400, 200_000).astype(np.uint32)
    keys, often, number = frequent_pairs(left, right, least)
    wanted = Counter(zip(left.tolist(), right.tolist()))
    assert dict(zip(keys.tolist(), often.tolist())) == {a << 32 | b: n for (a, b), n in wanted.items() if n >= least}
    for a, b, k in zip(left.tolist(), right.tolist(), number.tolist()):
        assert (k >= 0) == (wanted[a, b] >= least) and (k < 0 or keys[k] == a << 32 | b)


def test_repair_of_nothing():
    block = Block(write_block(np.zeros(0, np.int32), np.zeros(3, np.int64)))
    assert len(block.all()) == 0 and len(block.document(2)) == 0


@pytest.mark.parametrize("size", [50, 1_000_000])
def test_token_files_hold_the_ids_of_the_library(spark, library, size):
    values = SPECIAL + texts(150, 9)
    docs = documents(spark, values).repartition(5).withColumn("ids", F.lit(1))
    path = f"{work_folder(spark)}/files-{size}-{random.random()}"
    write_token_files(docs, path, PATH, block=size)
    start = 0
    rows = read_token_files(spark, path).orderBy("doc_id").collect()
    packed = {r.doc_id: r.ids for r in read_token_files(spark, path, packed=True).collect()}
    assert [r.doc_id for r in rows] == list(range(len(values)))
    for r, v in zip(rows, values):
        want = [*library.encode(v or "", add_special_tokens=False).ids, 0]
        assert (r.start, r.ids) == (start, want)
        assert zlib.crc32(packed[r.doc_id]) == zlib.crc32(np.array(want, "<u4").tobytes())
        start += len(want)


def test_token_files_of_odd_rows(spark):
    rows = [(None, "b"), (5, None), (5, None), (3, "x")]
    path = f"{work_folder(spark)}/odd-{random.random()}"
    write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), path, PATH)
    got = sorted((r.start, r.doc_id, len(r.ids)) for r in read_token_files(spark, path).collect())
    assert got == [(0, None, 2), (2, 3, 2), (4, 5, 1), (5, 5, 1)]
    path = f"{work_folder(spark)}/none-{random.random()}"
    write_token_files(spark.createDataFrame([], "doc_id long, text string"), path, PATH)
    assert read_token_files(spark, path).count() == 0
