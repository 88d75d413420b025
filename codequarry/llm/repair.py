"""Token files compressed by Re-Pair: frequent pairs of ids become rules, and any document can be decoded by itself."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from codequarry.llm.bpe import built, vocabulary
from codequarry.llm.chunks import ChunkEncoder, flat_ids, portions, slices
from codequarry.llm.shared import ship

#: First bytes of a block; a fixed value of this file format.
MAGIC = b"RPR1"
#: Tokens after which a block is closed; at least one document.
BLOCK = 400_000
#: A pair becomes a rule if it stands this often in a block. Fewer give smaller files and take longer.
LEAST = 32
#: Pairs that stand at least this part of the most frequent pair's times become rules in one round.
SHARE = 8
#: Entries of the tables of hashes that pairs are looked up in.
SLOT_BITS = 17
SLOTS = 1 << SLOT_BITS


def _slots(left: np.ndarray, right: np.ndarray, turn: int) -> np.ndarray:
    mixed = (left.astype(np.uint32) * np.uint32(2654435761 + 2 * turn) ^ right.astype(np.uint32)) * np.uint32(2246822519)
    return (mixed >> np.uint32(32 - SLOT_BITS)).astype(np.int64)


def frequent_pairs(left: np.ndarray, right: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``keys, often, number``: the pairs that stand ``least`` times, how often, and for each place its pair's number or -1.

    Exact: a slot of hashes with fewer places than ``least`` holds no such pair, and the pairs of all other places are sorted.
    Places then find the number of their pair by slot; pairs that share a slot are told apart by another hash.
    """
    number = np.full(len(left), -1, np.int32)
    slots = _slots(left, right, 0)
    at = np.flatnonzero((np.bincount(slots, minlength=SLOTS) >= least)[slots])
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), number
    slots, pair = slots[at], left[at].astype(np.int64) << 32 | right[at]
    ordered = np.sort(pair)
    ends = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], True))
    often = np.diff(ends, prepend=-1)
    keys, often = ordered[ends[often >= least]], often[often >= least]
    open_, turn = np.arange(len(keys), dtype=np.int32), 0
    while len(open_):
        own = _slots(keys[open_] >> 32, keys[open_] & 0xFFFFFFFF, turn)
        owner = np.full(SLOTS, -1, np.int32)
        owner[own] = open_
        held = owner[slots]
        right_one = (held >= 0) & (keys[held] == pair)
        number[at[right_one]] = held[right_one]
        lost = owner[own] != open_
        crowded = np.zeros(SLOTS, bool)
        crowded[own[lost]] = True
        rest = np.flatnonzero(crowded[slots] & ~right_one)
        open_, turn, at, pair = open_[lost], turn + 1, at[rest], pair[rest]
        slots = _slots(pair >> 32, pair & 0xFFFFFFFF, turn)
    return keys, often, number


def compress(ids: np.ndarray, counts: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``pairs, sequence, lengths``: Re-Pair of documents that stand one after another in ``ids``, ``counts`` long.

    Round by round, the pairs that stand most often become nonterminals (numbered on from the largest id) and replace
    their occurrences, never over the end of a document, until none stands ``least`` times. Where occurrences of a round
    overlap, every second one from the left is replaced; the rest are counted anew in the next round. A replacement makes
    only pairs with the new symbol, so a place whose pair was found rare is not counted again until its pair changes.
    ``lengths`` is what is left of each document.
    """
    if least < 2:
        raise ValueError("least must be at least 2")
    seq = ids.astype(np.uint32)
    last = np.zeros(len(seq), bool)
    ends = np.cumsum(counts) - 1
    last[ends[counts > 0]] = True
    live = ~last  # a pair that may be frequent begins here
    first = int(ids.max()) + 1 if len(ids) else 1
    pairs: list[np.ndarray] = []
    made = 0
    while True:
        at = np.flatnonzero(live)
        keys, often, number = frequent_pairs(seq[at], seq[at + 1], least)
        if not len(keys):
            break
        live[at[number < 0]] = False
        chosen = often >= often.max() // SHARE
        hit = (number >= 0) & chosen[number]
        at, number = at[hit], number[hit]
        fresh = np.ones(len(at), bool)
        fresh[1:] = np.diff(at) != 1
        order = np.arange(len(at))
        stay = (order - np.maximum.accumulate(np.where(fresh, order, 0))) % 2 == 0
        at, number = at[stay], number[stay]
        used = np.flatnonzero(np.bincount(number, minlength=len(keys)))
        symbols = np.zeros(len(keys), np.uint32)
        symbols[used] = np.arange(first + made, first + made + len(used))
        seq[at] = symbols[number]
        last[at] = last[at + 1]
        live[at] = ~last[at]
        before = at[at > 0] - 1
        gone = np.zeros(len(seq) + 1, bool)
        gone[at + 1] = True
        before = np.where(gone[before], before - 1, before)  # the symbol before may have lost its second half
        live[before] = ~last[before]
        rest = np.flatnonzero(~gone[:-1])  # found once: places are taken faster than masks are applied
        seq, last, live = seq.take(rest), last.take(rest), live.take(rest)
        pairs.append(np.stack([keys[used] >> 32, keys[used] & 0xFFFFFFFF], axis=1))
        made += len(used)
    table = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
    lengths = np.zeros(len(counts), np.int64)
    lengths[counts > 0] = np.diff(np.concatenate([[-1], np.flatnonzero(last)]))
    return table, seq.astype(np.int64), lengths


def expansion_lengths(pairs: np.ndarray, first: int) -> np.ndarray:
    """How many ids each rule stands for."""
    out: list[int] = []
    for a, b in pairs.tolist():
        out.append((out[a - first] if a >= first else 1) + (out[b - first] if b >= first else 1))
    return np.array(out, np.int64)


def expand(sequence: np.ndarray, pairs: np.ndarray, first: int, sizes: np.ndarray) -> np.ndarray:
    """The ids that ``sequence`` stands for. Every symbol knows where its ids go, so all symbols open up level by level."""
    lengths = np.where(sequence >= first, sizes[np.maximum(sequence - first, 0)] if len(sizes) else 1, 1)
    ends = np.cumsum(lengths)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
    symbols, places = sequence.astype(np.int64), ends - lengths
    while len(symbols):
        plain = symbols < first
        out[places[plain]] = symbols[plain]
        inner = np.flatnonzero(~plain)
        symbols, places = symbols.take(inner) - first, places.take(inner)
        left, right = pairs[symbols, 0], pairs[symbols, 1]
        step = np.where(left >= first, sizes[np.maximum(left - first, 0)], 1) if len(symbols) else left
        symbols, places = np.concatenate([left, right]), np.concatenate([places, places + step])
    return out


def write_block(ids: np.ndarray, counts: np.ndarray, least: int = LEAST) -> bytes:
    """A block of the file format: magic; documents, rules, symbols, first rule number (u32); tokens and symbols of each
    document (u32); rules as pairs (u32); expansion length of each rule (u32); symbols (u16 if they fit, else u32)."""
    pairs, sequence, lengths = compress(ids, counts, least)
    first = int(ids.max()) + 1 if len(ids) else 1
    wide = first + len(pairs) > 1 << 16
    head = MAGIC + struct.pack("<5I", len(counts), len(pairs), len(sequence), first, int(wide))
    body = [counts.astype("<u4"), lengths.astype("<u4"), pairs.astype("<u4"), expansion_lengths(pairs, first).astype("<u4"), sequence.astype("<u4" if wide else "<u2")]
    return head + b"".join(x.tobytes() for x in body)


class Block:
    """A block read back. ``document(k)`` opens only the symbols of one document."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a block of this format")
        docs, rules, symbols, self.first, wide = struct.unpack_from("<5I", data, 4)
        at = 24
        parts = []
        for n, kind in ((docs, "<u4"), (docs, "<u4"), (2 * rules, "<u4"), (rules, "<u4"), (symbols, "<u4" if wide else "<u2")):
            parts.append(np.frombuffer(data, kind, n, at).astype(np.int64))
            at += n * int(kind[2])
        self.counts, self.lengths, pairs, self.sizes, self.sequence = parts
        self.pairs = pairs.reshape(-1, 2)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)])

    def document(self, k: int) -> np.ndarray:
        return expand(self.sequence[self.begins[k] : self.begins[k + 1]], self.pairs, self.first, self.sizes)

    def all(self) -> np.ndarray:
        return expand(self.sequence, self.pairs, self.first, self.sizes)


def _library(content: str) -> ChunkEncoder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals the work to cores already
    library = Tokenizer.from_str(content)
    library.no_truncation()
    library.no_padding()
    special = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
    # in byte-level vocabularies each letter of a token stands for one byte
    widths = np.zeros(max(library.get_vocab().values()) + 1, np.int64)
    for token, i in library.get_vocab().items():
        widths[i] = len(token.encode()) if token in special else len(token)

    def alone(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return flat_ids([e.ids for e in library.encode_batch_fast(chunks, add_special_tokens=False)])

    def together(chunks: list[str], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        before = np.concatenate([[0], np.cumsum(widths[ids])])
        borders = np.cumsum([0, *map(len, map(str.encode, chunks))])
        cuts = np.searchsorted(before, borders)
        same = cuts[-1] == len(ids) and (before[cuts] == borders).all()
        return (ids, np.diff(cuts)) if same else alone(chunks)

    def many(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where a space or line feed follows a character that is no white space, pieces end. So chunks that begin and end like that are
        encoded as one text, some at a time, and the ids' widths tell where each ends; the others are encoded alone."""
        fits = np.array([c[:1] in (" ", "\n") and not c[-1].isspace() for c in chunks], bool)
        order = np.argsort(~fits, kind="stable")
        joint = [chunks[i] for i in order[: int(fits.sum())].tolist()]
        groups = [joint[i : i + 256] for i in range(0, len(joint), 256)]
        encodings = library.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False)
        parts = [together(g, np.array(e.ids, np.int32)) for g, e in zip(groups, encodings)]
        parts.append(alone([chunks[i] for i in order[len(joint) :].tolist()]))
        ids, found = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        lengths, begins = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        lengths[order], begins[order] = found, np.cumsum(found) - found
        return ids[np.repeat(begins - np.cumsum(lengths) + lengths, lengths) + np.arange(len(ids))], lengths

    return ChunkEncoder(many, special, 600_000)


FILE_SCHEMA = "part int, block int, base long, tokens long, documents array<{id}>, data binary"


def write_token_files(docs: DataFrame, path: str, vocabulary_path: str, end_id: int = 0, id_column: str = "doc_id",
                      text: str = "text", block: int = BLOCK, least: int = LEAST) -> None:
    """Encodes the texts with the tokenizers library, ends each with ``end_id``, and writes blocks under ``path``.

    Documents are dealt to tasks by ranges of their ids and sorted, so files and the blocks in them ascend by id (null
    first; equal ids by their text). Each block is a row: ``part`` (the file's number), ``block``, ``base`` (tokens of the file
    before it), ``tokens``, ``documents`` (their ids) and ``data`` (:func:`write_block`). Spark's writer commits files, so a lost
    task leaves none behind. Pairs that stand ``least`` times in a block become rules. A task holds one block of about ``block`` tokens and the text of a batch, or one long document.

    A null or empty text is the end id alone; repeated rows are written each. No documents: no rows. Other columns are not written.
    """
    spark = docs.sparkSession
    content = vocabulary(spark, vocabulary_path)
    slim = docs.select(F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()
    dealt = slim.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = built("library", content, _library)
        part, number, base, names = TaskContext.get().partitionId(), 0, 0, None
        held, sizes, ids = [], [], []

        def closed() -> pa.RecordBatch:
            nonlocal number, base, held, sizes, ids
            flat, counts = np.concatenate(held), np.concatenate(sizes)
            row = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([base], pa.int64()), pa.array([len(flat)], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), pa.concat_arrays(ids)), pa.array([write_block(flat, counts, least)], pa.binary()),
            ], ["part", "block", "base", "tokens", "documents", "data"])
            number, base, held, sizes, ids = number + 1, base + len(flat), [], [], []
            return row

        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            for begin, end in portions(texts):
                flat, counts = encoder.encode(texts[begin:end])
                held.append(np.insert(flat, np.cumsum(counts), end_id))
                sizes.append(counts + 1)
                ids.append(batch.column(0).slice(begin, end - begin))
                if sum(map(len, held)) >= block:
                    yield closed()
        if held:
            yield closed()

    dealt.mapInArrow(run, FILE_SCHEMA.format(id=kind)).write.parquet(path)


def read_token_files(spark: SparkSession, path: str, id_column: str = "doc_id", packed: bool = False) -> DataFrame:
    """Every document of the files under ``path``: its id, ``start`` (tokens of all documents before it), and ``ids``, an array of
    int, or with ``packed`` their bytes as little-endian unsigned 32-bit numbers."""
    ship(spark)
    files = spark.read.parquet(path)
    totals = files.groupBy("part").agg(F.sum("tokens").alias("n")).collect()  # one row per file
    offsets, before = [], 0
    for part, n in sorted(tuple(r) for r in totals):
        offsets.append((part, before))
        before += n
    starts = spark.createDataFrame(offsets, "part int, offset long")
    placed = files.join(starts, "part").select("documents", "data", (F.col("offset") + F.col("base")).alias("start"))
    kind = files.schema["documents"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch.column(1)[i].as_py())
                flat = block.all()
                bounds = np.concatenate([[0], np.cumsum(block.counts)])
                names, start = batch.column(0)[i].values, batch.column(2)[i].as_py()
                for first in range(0, len(names), 512):
                    cut = bounds[first : first + 513]
                    own = flat[cut[0] : cut[-1]]
                    if packed:
                        data = own.astype("<u4").tobytes()
                        lists = pa.array([data[4 * (a - cut[0]) : 4 * (b - cut[0])] for a, b in zip(cut, cut[1:])], pa.binary())
                    else:
                        lists = pa.ListArray.from_arrays(pa.array((cut - cut[0]).astype(np.int32)), pa.array(own.astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([names.slice(first, len(cut) - 1), pa.array(start + cut[:-1]), lists], [id_column, "start", "ids"])

    return placed.mapInArrow(run, f"`{id_column}` {kind.simpleString()}, start long, ids {'binary' if packed else 'array<int>'}")
