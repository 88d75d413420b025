"""Importance resampling of documents towards the word and pair distribution of target texts."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry.llm.shared import LOWER, UPPER, broadcast_if_small, checkpointed, ship, stored

#: Frequent words and pairs that are broadcast: at most so many, words of at most so many bytes. Some 20 MB whatever the corpus.
HEAD_WORDS, HEAD_PAIRS, HEAD_BYTES = 1 << 16, 1 << 18, 64
#: Distinct words, or pairs, that a task holds before it hands counts on; what it saw fewer times by then is no candidate for
#: the head. Bytes of text taken at a time.
HELD_WORDS, HELD_PAIRS, OFTEN, PORTION = 1 << 18, 1 << 22, 8, 1 << 20
#: Digits and ASCII letters, which become lower case, and all bytes of other characters belong to words; the rest separates them.
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_TO_WORDS = bytes(_LOWER[b] if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def word_runs(texts: list[bytes | None], most: int = PORTION) -> Iterator[tuple[list[bytes], np.ndarray, int]]:
    """The words of the texts in portions of some ``most`` bytes: the words, the text each belongs to, and how many at the
    front (0 or 1) were given before. A long text is cut between words, and its last word is given again for the next pair."""
    words: list[bytes] = []
    owners: list[np.ndarray] = []
    size = again = 0
    for row, text in enumerate(texts):
        data, begin, last = (text or b"").translate(_TO_WORDS), 0, None
        while begin < len(data):
            end = len(data)
            if end - begin > most:
                end = data.rfind(b" ", begin, begin + most) + 1 or data.find(b" ", begin + most) + 1 or end
            part = data[begin:end].split()
            if last is not None and not words:
                part.insert(0, last)
                again = 1
            words += part
            owners.append(np.full(len(part), row, np.int64))
            last = part[-1] if part else last
            size += end - begin
            begin = end
            if size >= most:
                yield words, np.concatenate(owners), again
                words, owners, size, again = [], [], 0, 0
    if words:
        yield words, np.concatenate(owners), again


class _Numbers(dict):
    """Numbers of words: those of the head are fixed, others are numbered behind them as they come."""

    def __init__(self, head: dict[bytes, int]):
        super().__init__(head)
        self.tail: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.tail.append(word)
        return number

    def forget(self) -> None:
        for word in self.tail:
            del self[word]
        self.tail = []


def _shifts(longest: int) -> np.ndarray:
    """What so many zero bytes make of each byte of a CRC-32 (its polynomial is a fixed value), for 0 to ``longest`` bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, step >> 1 ^ np.uint32(0xEDB88320), step >> 1)
    out = [np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)]
    for _ in range(longest):
        out.append(out[-1] >> 8 ^ step[out[-1] & 255])
    return np.stack(out)


class HeadTail:
    """Buckets of words and pairs. Words of the head have stored CRC states, pairs of the head a stored bucket; others take
    the CRC of their bytes, a pair by going on from the state of its first word over the bytes of its second."""

    def __init__(self, words: list[bytes], buckets: int, pairs: tuple[np.ndarray, np.ndarray] | None = None):
        self.words, self.buckets, self.pairs = words, buckets, pairs
        self.shift = _shifts(HEAD_BYTES + 1)
        self.head = self._states(words)
        self.numbers = _Numbers({w: i for i, w in enumerate(words)})

    @staticmethod
    def _states(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word: its CRC, that of the word behind a space, and the bytes of the latter."""
        n, space = len(words), zlib.crc32(b" ")
        return (np.fromiter(map(zlib.crc32, words), np.uint32, n), np.fromiter((zlib.crc32(w, space) for w in words), np.uint32, n),
                np.fromiter(map(len, words), np.int64, n) + 1)

    def _direct(self, states: tuple[np.ndarray, ...], first: np.ndarray, second: np.ndarray, word) -> np.ndarray:
        """Buckets of pairs by the CRC of their bytes: the first word's, moved over the bytes behind it, and the second's."""
        whole, spaced, size = states
        before, n = whole[first], size[second]
        some = np.minimum(n, HEAD_BYTES + 1)
        crc = spaced[second]
        for k in range(4):
            crc ^= self.shift[some, k, before >> np.uint32(8 * k) & np.uint32(255)]
        for i in np.flatnonzero(n > HEAD_BYTES + 1).tolist():
            crc[i] = zlib.crc32(b" " + word(int(second[i])), int(before[i]))
        return crc.astype(np.int64) % self.buckets

    def buckets_of(self, codes: np.ndarray) -> np.ndarray:
        """Buckets of pairs of head words: stored, or direct."""
        if self.pairs is None:
            return self._direct(self.head, codes // HEAD_WORDS, codes % HEAD_WORDS, self.words.__getitem__)
        keys, found = self.pairs
        place = _slot(codes, len(keys))
        out = found[place].astype(np.int64)
        other = keys[place] != codes
        rest = codes[other]
        out[other] = self._direct(self.head, rest // HEAD_WORDS, rest % HEAD_WORDS, self.words.__getitem__)
        return out

    def features(self, words: list[bytes], owner: np.ndarray, again: int):
        """Of a portion: the buckets of its words; of pairs of head words their codes and where their first word stands; of
        other pairs their buckets and where their first word stands."""
        numbers = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        tail, held = self.numbers.tail, len(self.words)
        states = tuple(map(np.concatenate, zip(self.head, self._states(tail))))
        single = states[0][numbers[again:]].astype(np.int64) % self.buckets
        at = np.flatnonzero(owner[1:] == owner[:-1])
        a, b = numbers[at], numbers[at + 1]
        inside = (a < held) & (b < held)
        direct = self._direct(states, a[~inside], b[~inside], lambda k: self.words[k] if k < held else tail[k - held])
        self.numbers.forget()
        return single, a[inside] * HEAD_WORDS + b[inside], at[inside], direct, at[~inside]


def _slot(codes: np.ndarray, size: int) -> np.ndarray:
    """Place of a pair in a table of ``size`` (a power of two)."""
    return (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(65 - size.bit_length())).astype(np.int64)


def pair_table(codes: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and their buckets by place; of pairs with one place the last stays, the others take the direct way."""
    keys, found = np.full(4 * HEAD_PAIRS, -1, np.int64), np.zeros(4 * HEAD_PAIRS, np.int32)
    place = _slot(codes, len(keys))
    keys[place] = codes
    held = keys[place] == codes
    found[place[held]] = buckets[held]
    return keys, found


def _texts(batch: pa.RecordBatch, column: int, rows: int = 512) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    for first in range(0, batch.num_rows, rows):
        part = batch.slice(first, rows)
        yield part, part.column(column).to_pylist()


def _rows(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def _count_words(texts: DataFrame) -> DataFrame:
    """``word`` (binary) and ``n``: words that some task saw often, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def hand() -> pa.RecordBatch:
            often = [(w, n) for w, n in counts.items() if n >= OFTEN and len(w) <= HEAD_BYTES]
            return _rows(word=pa.array([w for w, _ in often], pa.binary()), n=pa.array([n for _, n in often], pa.int64()))

        for batch in batches:
            for _, values in _texts(batch, 0):
                for words, _, again in word_runs(values):
                    counts.update(words[again:])
                    if len(counts) > HELD_WORDS:
                        yield hand()
                        counts.clear()
        yield hand()

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _count_features(texts: DataFrame, head: Broadcast, buckets: int) -> DataFrame:
    """``key`` and ``n``: pairs of head words that a task saw often under their code, all other features under ``-1 - bucket``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, codes, held = HeadTail(head.value[0], buckets), [], 0
        direct = np.zeros(buckets, np.int64)

        def hand() -> pa.RecordBatch:
            every, n = np.unique(np.concatenate([np.zeros(0, np.int64), *codes]), return_counts=True)
            rare = n < OFTEN
            np.add.at(direct, table.buckets_of(every[rare]), n[rare])
            filled = np.flatnonzero(direct)
            return _rows(key=pa.array(np.concatenate([every[~rare], -1 - filled])), n=pa.array(np.concatenate([n[~rare], direct[filled]])))

        for batch in batches:
            for _, values in _texts(batch, 0):
                for words, owner, again in word_runs(values):
                    single, inner, _, outer, _ = table.features(words, owner, again)
                    direct += np.bincount(single, minlength=buckets) + np.bincount(outer, minlength=buckets)
                    codes.append(inner)
                    held += len(inner)
                    if held > HELD_PAIRS:
                        yield hand()
                        codes, held = [], 0
                        direct[:] = 0
        yield hand()

    return texts.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows with the highest ``n``, down to a level (a sixteenth of a doubling) that leaves ``most`` at most."""
    level = F.floor(16 * F.log2("n")).cast("int")
    # one row per level: 16 for each doubling of the largest count
    left, least = most, 2**30
    for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("rows")).orderBy(F.desc("level")).collect():
        left -= r["rows"]
        if left < 0:
            break
        least = r["level"]
    return counts.filter(level >= least)


def _totals(features: DataFrame, head: Broadcast, buckets: int) -> DataFrame:
    """``bucket, n``: pairs of head words, each distinct one once, and what had its bucket already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = HeadTail(head.value[0], buckets)
        for batch in batches:
            key, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            bucket = np.where(key < 0, -1 - key, 0)
            bucket[key >= 0] = table.buckets_of(key[key >= 0])
            yield _rows(bucket=pa.array(bucket), n=pa.array(n))

    return features.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text: str = "text", buckets: int = 10_000,
                 heads: tuple[int, int] = (HEAD_WORDS, HEAD_PAIRS)) -> tuple[DataFrame, Broadcast]:
    """``bucket, gain`` for every bucket, and the head (frequent words; frequent pairs and their buckets) for scoring.

    Words of ``docs`` are counted; the most frequent ones, as many as ``heads`` says at most, make the head. Then every feature of every
    text is counted: pairs of head words that are frequent in a task by themselves, all others in their bucket right away.
    Both feed the totals, which are exact wherever the head ends; the most frequent pairs, as many
    as ``heads`` says at most, are its pairs.
    """
    if not 0 < buckets <= 1 << 20:
        raise ValueError("buckets must be 1 to 1,048,576")
    if heads[0] > HEAD_WORDS or heads[1] > HEAD_PAIRS:
        raise ValueError(f"heads must be {HEAD_WORDS} words and {HEAD_PAIRS} pairs at most")
    spark = docs.sparkSession
    ship(spark)
    plain = lambda df: df.select(F.col(f"`{text}`").cast("binary").alias("text"))
    counted = stored(_count_words(plain(docs)), "words")
    words = sorted(bytes(r["word"]) for r in _most_frequent(counted, heads[0]).select("word").collect())
    head = spark.sparkContext.broadcast((words, None))
    features = stored(_count_features(plain(docs), head, buckets), "features")
    pairs = _most_frequent(features.filter("key >= 0"), heads[1]).select("key").orderBy("key").toArrow().column("key")
    codes = pairs.to_numpy().astype(np.int64)
    head = spark.sparkContext.broadcast((words, pair_table(codes, HeadTail(words, buckets).buckets_of(codes))))
    source = _totals(features, head, buckets)
    wanted = _totals(_count_features(plain(target), head, buckets), head, buckets)
    every = spark.range(buckets).select(F.col("id").alias("bucket"))
    both = every.join(source.withColumnRenamed("n", "s"), "bucket", "left").join(
        wanted.withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"])
    both = checkpointed(both)
    # one row: the totals of all buckets
    whole = both.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    real = lambda x: F.lit(x).cast("double") if isinstance(x, int) else x.cast("double")
    share = (real(F.col("t")) + 1) * (real(whole["s"]) + buckets) / ((real(F.col("s")) + 1) * (real(whole["t"]) + buckets))
    return both.select("bucket", F.floor(1000 * F.log(share)).cast("long").alias("gain")), head


def document_weights(docs: DataFrame, gains: DataFrame, head: Broadcast, id_column: str = "doc_id", text: str = "text",
                     buckets: int = 10_000) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words``, ``n_features`` and ``weight``, the floored mean of its features' gains."""
    # one row per bucket, whatever the corpus
    by_bucket = docs.sparkSession.sparkContext.broadcast(
        np.array([r["gain"] for r in gains.orderBy("bucket").collect()], np.int64))
    slim = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = head.value
        table, gain = HeadTail(words, buckets, pairs), by_bucket.value
        for batch in batches:
            for part, values in _texts(batch, 1):
                size, total, n_words = (np.zeros(part.num_rows, np.int64) for _ in range(3))
                for words, owner, again in word_runs(values):
                    single, inner, at, outer, beside = table.features(words, owner, again)
                    for rows, found in ((owner[again:], gain[single]), (owner[at], gain[table.buckets_of(inner)]), (owner[beside], gain[outer])):
                        size += np.bincount(rows, minlength=part.num_rows)
                        total += np.bincount(rows, found, part.num_rows).astype(np.int64)  # below 2^53: exact
                    n_words += np.bincount(owner[again:], minlength=part.num_rows)
                weight = np.where(size > 0, total // np.maximum(size, 1), 0)
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, (n_words, size, weight))], ["id", "n_words", "n_features", "weight"])

    schema = T.StructType([slim.schema["id"], *(T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight"))])
    return slim.mapInArrow(run, schema)


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, buckets: int = 10_000,
             id_column: str = "doc_id", text: str = "text", heads: tuple[int, int] = (HEAD_WORDS, HEAD_PAIRS)) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_features``, ``weight``, ``score`` and ``rank`` (null if it is not drawn).

    Features are all words and pairs of neighbouring words of the whole text; each falls into the bucket of its CRC-32. A
    bucket's gain is the log ratio of its smoothed shares in ``target`` and in ``docs``; the weight of a document is the mean
    gain of its features, the score adds Gumbel noise that only ``seed`` and the id fix. Of the documents with
    ``least_words`` words, ``percent`` in a hundred with the highest scores are drawn without replacement; equal scores go by
    smaller id, then by fewer features and lower weight.

    Scores are whole numbers in a range that does not grow with the corpus (gains by the logarithm of counts, noise within
    -3,100 to 22,900), so their counts are a small table from which ranks begin; inside one score documents are ranked by id. The noise keeps
    scores apart, also those of copies.

    Null texts have no words, no features and weight 0; a null id takes the noise of the text ``null`` and comes after all
    others. Repeated rows are ranked one by one and share their noise. No documents: no rows; an empty target: gains from
    the smoothing alone. Other columns are not read.
    """
    if not 0 <= percent <= 100:
        raise ValueError("percent must be 0 to 100")
    gains, head = bucket_gains(docs, target, text, buckets, heads)
    weighed = document_weights(docs, gains, head, id_column, text, buckets)
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    draw = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((draw + 0.5) / 4294967296.0))).cast("long")
    scored = stored(weighed.withColumn("score", F.col("weight") + noise), "scored")
    able = F.col("n_words") >= least_words
    # one row per score: bounded by the range of scores
    sizes = scored.filter(able).groupBy("score").agg(F.count("*").alias("n")).orderBy(F.desc("score")).collect()
    most, before, begins = sum(r["n"] for r in sizes) * percent // 100, 0, []
    for r in sizes:
        if before >= most:
            break
        begins.append((r["score"], before))
        before += r["n"]
    spark = docs.sparkSession
    first = broadcast_if_small(spark.createDataFrame(begins, "score long, before long"), len(begins))
    lowest = begins[-1][0] if begins else 2**63 - 1
    near = able & (F.col("score") >= lowest)
    drawn = scored.filter(near).join(first, "score")
    order = Window.partitionBy("score").orderBy(F.asc_nulls_last("id"), "n_features", "weight")
    place = (F.col("before") + F.row_number().over(order)).cast("long")
    columns = [F.col("id").alias(id_column), "n_features", "weight", "score"]
    ranked = drawn.withColumn("place", place).select(*columns, F.when(F.col("place") <= most, F.col("place")).alias("rank"))
    others = scored.filter(~near).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(others)

