"""Byte-level BPE: exact ids of whole texts by dynamic programming over prefixes, and back."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry.llm.chunks import SPLIT, ChunkEncoder, give_back, portions, slices, split_special
from codequarry.llm.shared import ship


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: printable ones for themselves, the rest from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Fits(dict):
    """Which pairs of tokens (left << 32 | right) can stand side by side; found as asked for."""

    def __init__(self, fits):
        super().__init__()
        self.fits = fits

    def __missing__(self, pair: int) -> bool:
        found = self[pair] = self.fits(pair >> 32, pair & 0xFFFFFFFF)
        return found


class ByteBPE:
    """A vocabulary file's merges, as tables over ranks: bytes are 0 to 255, merge ``k`` makes rank ``256 + k``."""

    def __init__(self, content: str):
        file = json.loads(content)
        vocab = file["model"]["vocab"]
        letters = byte_letters()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in file["model"]["merges"]]
        rank = {c: b for c, b in letters.items()}
        self.pairs: dict[tuple[int, int], int] = {}
        self.head, self.tail = list(range(256)), list(range(256))
        self.ids = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.bytes = [bytes([b]) for b in range(256)]
        for left, right in merges:
            if left + right in rank:
                raise ValueError(f"two merges make {left + right!r}")
            a, b, new = rank[left], rank[right], len(self.head)
            rank[left + right] = new
            self.pairs[a, b] = new
            self.head.append(a)
            self.tail.append(b)
            self.ids.append(vocab[left + right])
            self.bytes.append(self.bytes[a] + self.bytes[b])
        self.special = {t["content"]: t["id"] for t in file.get("added_tokens", []) if not t["normalized"]}
        # suffix links lead from each match to the next shorter token that ends at the same byte
        self.matches = ahocorasick.Automaton()
        for t, b in enumerate(self.bytes):
            self.matches.add_word(b.decode("latin-1"), (t, len(b)))
        self.matches.make_automaton()
        self.size = max([*self.ids, *self.special.values()]) + 1
        self.piece = lru_cache(1 << 16)(self._piece)
        self.known = _Fits(self._fits)
        self.lengths = [len(b) for b in self.bytes]
        # ASCII letters after at most one space are one piece; no special token hides in them, unless it is of the same
        self.lettered = any(s.replace(" ", "").isalpha() for s in self.special)
        self.whole: list[bool | None] = [True] * 256 + [None] * (len(self.head) - 256)

    def _fits(self, left: int, right: int) -> bool:
        """Whether BPE of the two tokens' joint bytes gives just these two.

        Undoes, beside their border and one at a time, the later of the merges that made them. If what then meets at the
        border would have been merged before that, the border cannot have lasted.
        """
        before = len(self.head)
        while True:
            joint = self.pairs.get((left, right))
            if joint is not None and joint < before:
                return False
            if left < 256 and right < 256:
                return True
            if left > right:
                before, left = left, self.tail[left]
            else:
                before, right = right + 1, self.head[right]

    def merged(self, text: bytes) -> list[int]:
        """Ranks by the definition: the earliest possible merge, leftmost first, as long as there is one."""
        ranks = list(text)
        while len(ranks) > 1:
            best, at = min((self.pairs.get(p, len(self.head)), i) for i, p in enumerate(zip(ranks, ranks[1:])))
            if best == len(self.head):
                break
            ranks[at : at + 2] = [best]
        return ranks

    def _is_whole(self, token: int) -> bool:
        if self.whole[token] is None:
            self.whole[token] = self.merged(self.bytes[token]) == [token]
        return self.whole[token]

    def _piece(self, text: str) -> tuple[int, ...]:
        data = text.encode("utf-8")
        last = [-1] * (len(data) + 1)
        known, whole = self.known, self.whole
        if len(known) > 1 << 17:
            known.clear()
        for end, (token, length) in self.matches.iter(data.decode("latin-1")):
            end += 1
            if last[end] >= 0:
                continue
            if end != length and not known[last[end - length] << 32 | token]:
                continue
            if whole[token] or self._is_whole(token):
                last[end] = token
        out, at = [], len(data)
        ids, lengths = self.ids, self.lengths
        while at:
            token = last[at]
            out.append(ids[token])
            at -= lengths[token]
        out.reverse()
        return tuple(out)

    def forget(self) -> None:
        """Empties what is remembered of texts; results do not depend on it."""
        self.piece.cache_clear()
        self.known.clear()

    def encode(self, text: str) -> list[int]:
        bare = text[1:] if text[:1] == " " else text
        if bare.isascii() and bare.isalpha() and not self.lettered:
            return list(self._piece(text))  # remembered by whole chunks already
        out: list[int] = []
        for part, is_special in split_special(text, self.special):
            if is_special:
                out.append(self.special[part])
            else:
                for p in SPLIT.findall(part):
                    out.extend(self.piece(p) if len(p) < 64 else self._piece(p))
        return out


def byte_table(content: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all ids of a vocabulary file one after another, and where each id's begin (one more entry for the end)."""
    file = json.loads(content)
    letters = byte_letters()
    by_id = {i: bytes(map(letters.__getitem__, token)) for token, i in file["model"]["vocab"].items() if all(c in letters for c in token)}
    by_id |= {t["id"]: t["content"].encode() for t in file.get("added_tokens", []) if not t["normalized"]}
    parts = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


_BUILT: dict[tuple[str, int], object] = {}


def built(key: str, content: Broadcast, make, beside: tuple[str, ...] = ()):
    """What ``make`` builds from a broadcast vocabulary, once for each Python worker. Workers outlive a stage, so what was
    built for other keys (but those ``beside``) goes."""
    name = (key, hash(content.value))
    if name not in _BUILT:
        for other in [n for n in _BUILT if n[0] not in (key, *beside)]:
            del _BUILT[other]
        _BUILT[name] = make(content.value)
        give_back()  # building takes several times what is kept
    return _BUILT[name]


def release() -> None:
    """Drops all that earlier stages built in this Python worker: for stages that use no vocabulary."""
    if _BUILT:
        _BUILT.clear()
        give_back()


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """A vocabulary file (a few MB, whatever the corpus), read on the driver and sent to the executors once."""
    ship(spark)
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _encoder(content: str) -> ChunkEncoder:
    bpe = ByteBPE(content)
    encoder = ChunkEncoder(lambda chunks: [bpe.encode(c) for c in chunks], bpe.special)
    encoder.forget = bpe.forget
    return encoder


def bpe_encode(docs: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids`` (array of int) in place of the text: the ids of each whole text under the vocabulary.

    For each prefix of a piece, its last token is the one token ending there that fits the last token of the prefix
    before it; at most one can, so following these back from the end gives the exact ids. Time is proportional to the
    bytes, however long a piece is. Null counts as the empty text, which has no ids; other columns are kept as they are,
    a column already named ``ids`` gives way; row order, ties and repeated rows do not matter as rows are independent.
    """
    spark, rest = docs.sparkSession, [c for c in docs.columns if c not in (text, ids)]
    content = vocabulary(spark, vocabulary_path)
    slim = docs.select(*[F.col(f"`{c}`") for c in rest], F.coalesce(F.col(text), F.lit("")).alias(text))
    schema = T.StructType([f for f in slim.schema if f.name != text] + [T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = built("bpe", content, _encoder, ("bytes",))
        for batch in slices(batches):
            texts = batch.column(len(rest)).to_pylist()
            for begin, end in portions(texts):
                flat, counts = encoder.encode(texts[begin:end])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(begin, end - begin) for i in range(len(rest))), lists], [*rest, ids])
        encoder.forget()
        encoder.done()

    return slim.mapInArrow(run, schema)


def bpe_decode(encoded: DataFrame, vocabulary_path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``encoded`` with a column ``text``: what its ids stand for. Null ids give an empty text; ids outside the vocabulary
    add nothing; bytes that are no UTF-8 become U+FFFD. Other columns are kept, one already named ``text`` gives way."""
    spark, rest = encoded.sparkSession, [c for c in encoded.columns if c != text]
    content = vocabulary(spark, vocabulary_path)
    slim = encoded.select(*[F.col(f"`{c}`") for c in rest])
    at = rest.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, begins = built("bytes", content, byte_table, ("bpe",))
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                lists = batch.column(at)
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                known = (flat >= 0) & (flat < len(begins) - 1)
                flat = np.where(known, flat, 0)
                lengths = np.where(known, begins[flat + 1] - begins[flat], 0)
                ends = np.cumsum(lengths)
                data = table[np.repeat(begins[flat] - ends + lengths, lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]
                counts = np.array([0 if n is None else n for n in lists.value_lengths().to_pylist()], np.int64)
                bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
                texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*rest, text])

    return slim.mapInArrow(run, T.StructType([*slim.schema, T.StructField(text, T.StringType())]))
