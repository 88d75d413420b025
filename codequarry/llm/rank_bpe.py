"""Byte-level BPE by a rank file: chunks pre-tokenised in parallel, stitched where boundaries agree, pieces encoded."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry.llm.chunks import PieceMemory, portions, slices
from codequarry.llm.shared import broadcast_if_small, checkpointed, ship, stored

#: Characters of a chunk; texts up to it are one chunk. Characters two neighbouring chunks share.
CHUNK, OVERLAP = 1 << 15, 1 << 9
#: Characters that the split pattern may look at behind the start of a piece before it is settled: ``'ll`` has three.
AHEAD = 3
#: Bytes of a piece up to which pieces are merged side by side; the rank of joint bytes that have none.
LONGEST, NONE = 64, 1 << 40


class Ranks:
    """A rank file: ids of single pieces, or of many at once."""

    def __init__(self, content: bytes):
        self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}
        self.bytes = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        joint = [(left << 32 | right, r) for token, r in self.rank.items() for i in range(1, len(token))
                 if (left := self.rank.get(token[:i])) is not None and (right := self.rank.get(token[i:])) is not None]
        codes, ranks = np.array(sorted(joint), np.int64).reshape(-1, 2).T
        # one more entry, which nothing equals, for what stands behind the last
        self.codes, self.joint = np.append(codes, np.int64(-1)), np.append(ranks, NONE)
        self.bytes_joint = self._joint(np.repeat(self.bytes, 256), np.tile(self.bytes, 256)).reshape(256, 256)
        self.memory = PieceMemory(self.many)

    def _joint(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the joint bytes of two ids, NONE if they have none."""
        code = left << 32 | right
        place = np.searchsorted(self.codes[:-1], code)
        return np.where(self.codes[place] == code, self.joint[place], NONE)

    def encode(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of lists of pieces one after another, and how many each list has."""
        self.memory.make_room()
        return self.memory.ids_of(*self.memory.slots_of(lists))

    def many(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces one after another, and how many each has: those with a rank directly, long ones singly, the rest
        side by side, in blocks of like length."""
        data = [p.encode() for p in pieces]
        found: list[np.ndarray | None] = [None] * len(data)
        waiting: dict[int, list[int]] = {}
        for i, piece in enumerate(data):
            own = self.rank.get(piece)
            if own is not None or not piece:
                found[i] = np.array([own] if piece else [], np.int64)
            elif len(piece) > LONGEST:
                found[i] = np.array(self.ids_of(piece), np.int64)
            else:
                waiting.setdefault(max(4, 1 << (len(piece) - 1).bit_length()), []).append(i)
        for width, numbers in waiting.items():
            for first in range(0, len(numbers), 8192):
                some = numbers[first : first + 8192]
                for i, ids in zip(some, self._merged([data[i] for i in some], width)):
                    found[i] = ids
        lengths = np.fromiter(map(len, found), np.int32, len(found))
        return (np.concatenate(found) if found else np.zeros(0)).astype(np.int32), lengths

    def _merged(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        """As ``ids_of`` for pieces of up to ``width`` bytes, a merge of each at a time: rows of parts, and beside them the ranks
        of the joint bytes of neighbours. The lowest, leftmost first, becomes a part, and what is right of it moves up."""
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(len(pieces), width)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        column = np.arange(width)
        parts = self.bytes[raw]
        border = np.where(column[:-1] < size[:, None] - 1, self.bytes_joint[raw[:, :-1], raw[:, 1:]], NONE)
        row, out = np.arange(len(pieces)), [None] * len(pieces)
        while len(row):
            at = border.argmin(axis=1)
            lowest = border[np.arange(len(row)), at]
            done = lowest == NONE
            if done.any():
                for i in np.flatnonzero(done).tolist():
                    out[row[i]] = parts[i, : size[i]]
                row, parts, border, size, at, lowest = (x[~done] for x in (row, parts, border, size, at, lowest))
                if not len(row):
                    break
            every = np.arange(len(row))
            parts[every, at] = lowest
            parts[:, :-1] = np.where(column[:-1] > at[:, None], parts[:, 1:], parts[:, :-1])
            border[:, :-1] = np.where(column[:-2] >= at[:, None], border[:, 1:], border[:, :-1])
            border[:, -1] = NONE
            size = size - 1
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < size - 1)
            border[left, at[left] - 1] = self._joint(parts[left, at[left] - 1], lowest[left])
            border[right, at[right]] = self._joint(lowest[right], parts[right, at[right] + 1])
        return out

    def ids_of(self, piece: bytes) -> list[int]:
        """A piece that has a rank is that id. Otherwise the neighbours whose joint bytes have the lowest rank are merged,
        leftmost first, until no joint bytes have one. A heap of candidates keeps the time near the number of bytes."""
        rank = self.rank
        if piece in rank:
            return [rank[piece]]
        n = len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ends = list(range(1, n + 1))
        waiting = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank.get(piece[i : i + 2])) is not None]
        heapq.heapify(waiting)
        while waiting:
            _, left, middle, end = heapq.heappop(waiting)
            # a candidate stands if its two parts still are what they were
            if ends[left] != middle or middle >= n or ends[middle] != end:
                continue
            ends[left], ends[middle] = end, -1
            right = after[middle]
            after[left] = right
            if right < n:
                before[right] = left
                if (r := rank.get(piece[left : ends[right]])) is not None:
                    heapq.heappush(waiting, (r, left, end, ends[right]))
            if (first := before[left]) >= 0 and (r := rank.get(piece[first:end])) is not None:
                heapq.heappush(waiting, (r, first, left, end))
        out, at = [], 0
        while at < n:
            out.append(rank[piece[at : ends[at]]])
            at = ends[at]
        return out


def packed(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The ids of each list as little-endian 32-bit numbers."""
    data, ends = ids.astype("<u4").tobytes(), np.cumsum(counts, dtype=np.int64) * 4
    return pa.array([data[a:b] for a, b in zip((ends - 4 * counts).tolist(), ends.tolist())], pa.binary())


_BUILT: dict[int, Ranks] = {}


def _ranks(content: Broadcast) -> Ranks:
    """The table of a rank file, once for each Python worker."""
    key = hash(content.value)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Ranks(content.value)
    return _BUILT[key]


def _file(spark: SparkSession, path: str) -> Broadcast:
    """A rank file (under a megabyte, whatever the corpus), read on the driver and sent to the executors once."""
    ship(spark)
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _encode_whole(texts: DataFrame, content: Broadcast, pattern: str, ids: str) -> DataFrame:
    """Texts of one chunk each: the last column is the text, which ``ids`` replaces."""
    rest = texts.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, split = _ranks(content), regex.compile(pattern)
        for batch in slices(batches):
            texts = batch.column(len(rest)).to_pylist()
            for begin, end in portions(texts, 1 << 20):
                found = ranks.encode([split.findall(t) for t in texts[begin:end]])
                yield pa.RecordBatch.from_arrays([*(c.slice(begin, end - begin) for c in batch.columns[:-1]), packed(*found)], [*rest, ids])
        ranks.memory.done()

    return texts.mapInArrow(run, T.StructType([*texts.schema[:-1], T.StructField(ids, T.BinaryType())]))


def _cut(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``digest, begin, stop, final, part``: the chunks of long texts. ``part`` goes ``overlap`` characters beyond ``stop``,
    where the next chunk begins; the final one ends with its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                digest, text = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                for begin in range(0, max(1, len(text)), chunk):
                    final = begin + chunk + overlap >= len(text)
                    part = text[begin : begin + chunk + overlap]
                    yield pa.RecordBatch.from_pydict({
                        "digest": [digest], "begin": pa.array([begin], pa.int64()), "stop": pa.array([len(text) if final else begin + chunk], pa.int64()),
                        "final": [final], "part": [part]})
                    if final:
                        break

    return texts.mapInArrow(run, "digest string, begin long, stop long, final boolean, part string")


def _pretokenised(chunks: DataFrame, overlap: int, pattern: str) -> DataFrame:
    """``chunks`` with the lengths of their pieces, and the boundaries in what they share with the chunk before (``head``)
    and with the chunk behind (``tail``; without those so near the end of the part that more text could change them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern)
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                begin, stop, final, part = (one.column(i)[0].as_py() for i in range(1, 5))
                lengths = np.fromiter(map(len, split.findall(part)), np.int32)
                bounds = begin + np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
                head = bounds[bounds <= begin + overlap]
                tail = bounds[(bounds >= stop) & (bounds <= begin + len(part) - AHEAD)] if not final else bounds[:0]
                lists = [pa.array([x.tolist()], pa.list_(k)) for x, k in ((lengths, pa.int32()), (head, pa.int64()), (tail, pa.int64()))]
                yield pa.RecordBatch.from_arrays([*one.columns, *lists], [*one.schema.names, "lengths", "head", "tail"])

    return chunks.mapInArrow(run, T.StructType([
        *chunks.schema, T.StructField("lengths", T.ArrayType(T.IntegerType())), T.StructField("head", T.ArrayType(T.LongType())),
        T.StructField("tail", T.ArrayType(T.LongType()))]))


def _stitched(chunks: DataFrame, overlap: int, pattern: str) -> tuple[DataFrame, DataFrame]:
    """The pre-tokenised chunks, and for each where its own pieces begin and end: at the first boundary it shares with the
    chunk before and with the chunk behind. The first chunk is right from its start, a chunk is right from a boundary it
    shares with one that is right there, so every such boundary is one of the whole text. Chunks that share none with the
    one before (a piece longer than the overlap) are joined to it and cut anew, until all are stitched."""
    ready = stored(_pretokenised(chunks, overlap, pattern), "pieces")
    order = Window.partitionBy("digest").orderBy("begin")
    while True:
        met = F.array_min(F.array_intersect(F.lag("tail").over(order), "head"))
        slim = checkpointed(ready.select("digest", "begin", F.when(F.lag("begin").over(order).isNull(), F.col("begin")).otherwise(met).alias("own")))
        loose = slim.filter("own IS NULL").select("digest").distinct()
        if loose.isEmpty():
            ends = F.lead("own").over(order)
            return ready, slim.select("digest", "begin", "own", ends.alias("until"))
        bonds = slim.join(loose, "digest").withColumn(
            "run", F.max(F.when(F.col("own").isNotNull(), F.col("begin"))).over(order)).select("digest", "begin", "run")
        runs = ready.select("digest", "begin", "stop", "final", "part").join(bonds, ["digest", "begin"])
        listed = F.array_sort(F.collect_list(F.struct("begin", "stop", "final", "part")))
        joined = runs.groupBy("digest", "run").agg(listed.alias("c")).select(
            "digest", F.col("run").alias("begin"), F.element_at("c", -1)["stop"].alias("stop"), F.element_at("c", -1)["final"].alias("final"),
            F.concat(F.array_join(F.transform(F.slice("c", F.lit(1), F.size("c") - 1), lambda x: F.substring(
                x["part"], F.lit(1), (x["stop"] - x["begin"]).cast("int"))), ""), F.element_at("c", -1)["part"]).alias("part"))
        ready = stored(ready.join(loose, "digest", "left_anti").unionByName(_pretokenised(joined, overlap, pattern)), "pieces")


def _encode_chunks(ready: DataFrame, own: DataFrame, content: Broadcast, ids: str) -> DataFrame:
    """``digest`` and ``ids`` of the whole text."""
    # two longs a chunk; sent to all only if few, else chunks are dealt once more
    rows = own.count()
    mine = ready.select("digest", "begin", "part", "lengths").join(broadcast_if_small(own, rows), ["digest", "begin"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(content)
        for batch in batches:
            for row in range(batch.num_rows):
                digest, begin, part, lengths, first, until = (batch.column(i)[row] for i in range(6))
                part, begin = part.as_py(), begin.as_py()
                ends = np.cumsum(lengths.values.to_numpy(), dtype=np.int64)
                ends = ends[(ends > first.as_py() - begin) & (ends <= (until.as_py() or begin + len(part)) - begin)]
                starts = np.concatenate([[first.as_py() - begin], ends[:-1]]) if len(ends) else ends
                found = ranks.encode([[part[a:b] for a, b in zip(starts.tolist(), ends.tolist())]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest.as_py()]), pa.array([begin], pa.int64()), packed(*found)], ["digest", "begin", "ids"])
        ranks.memory.done()

    encoded = mine.mapInArrow(run, "digest string, begin long, ids binary")

    def join(key, group):
        return group.sort_values("begin").groupby("digest", as_index=False).agg({"ids": b"".join}).rename(columns={"ids": ids})

    return encoded.groupBy("digest").applyInPandas(join, f"digest string, `{ids}` binary")


def rank_encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids", chunk: int = CHUNK,
                overlap: int = OVERLAP) -> DataFrame:
    """``docs`` with ``ids`` in place of the text: the ids of each whole text, packed as little-endian 32-bit numbers.

    ``pattern`` splits a text into pieces, and each piece is encoded by the ranks of its parts. Texts of up to ``chunk``
    characters stay where they are. Longer ones are cut into chunks that overlap; each chunk goes to a task of its own, is
    split from its own start, and neighbours are stitched at the first boundary both found in what they share. Equal long
    texts are encoded once: chunks are keyed by the text's digest, so a large group of copies is one set of chunks.

    Null counts as the empty text, which has no ids. Special tokens are ordinary text. Row order, ties and repeated rows do
    not matter; an empty table gives no rows. Other columns are kept, one already named ``ids`` gives way.
    """
    if overlap <= AHEAD or chunk <= overlap:
        raise ValueError(f"chunk must be above overlap, and overlap above {AHEAD}")
    spark, rest = docs.sparkSession, [c for c in docs.columns if c not in (text, ids)]
    content = _file(spark, ranks_path)
    slim = docs.select(*[F.col(f"`{c}`") for c in rest], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(text))
    long = F.length(F.col(f"`{text}`")) > chunk
    short = _encode_whole(slim.filter(~long), content, pattern, ids)
    # a digest cannot clash with other columns: these are renamed by place on the way
    names = [f"c{i}" for i in range(len(rest))]
    large = slim.filter(long).toDF(*names, "text").withColumn("digest", F.sha2("text", 256))
    cut = _cut(large.select("digest", "text"), chunk, overlap)
    # equal chunks of equal texts; this also deals the chunks of a long text to all tasks
    distinct = cut.groupBy("digest", "begin").agg(F.first("stop").alias("stop"), F.first("final").alias("final"), F.first("part").alias("part"))
    ready, own = _stitched(distinct, overlap, pattern)
    encoded = _encode_chunks(ready, own, content, "ids")
    found = large.select(*names, "digest").join(encoded, "digest").select(*names, "ids").toDF(*rest, ids)
    return short.unionByName(found) if len({*rest}) == len(rest) else short.union(found)


def rank_decode(encoded: DataFrame, ranks_path: str, ids: str = "ids", data: str = "bytes") -> DataFrame:
    """``encoded`` with a binary column ``bytes``: the bytes of all its ids one after another. Null ids give no bytes, ids
    outside the file add none, bytes of half an id at the end are left out. Other columns are kept, one named ``bytes`` gives way."""
    spark, rest = encoded.sparkSession, [c for c in encoded.columns if c != data]
    content, at = _file(spark, ranks_path), rest.index(ids)
    slim = encoded.select(*[F.col(f"`{c}`") for c in rest])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {i: b for b, i in _ranks(content).rank.items()}
        table = [tokens.get(i, b"") for i in range(max(tokens, default=-1) + 1)]
        for whole in batches:
            for first in range(0, whole.num_rows, 64):
                batch = whole.slice(first, 64)
                out = []
                for data_of in batch.column(at).to_pylist():
                    numbers = np.frombuffer(data_of or b"", "<u4", len(data_of or b"") // 4)
                    out.append(b"".join(map(table.__getitem__, numbers[numbers < len(table)].tolist())))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*rest, data])

    return slim.mapInArrow(run, T.StructType([*slim.schema, T.StructField(data, T.BinaryType())]))
