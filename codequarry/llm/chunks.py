"""Encoding of many texts through a bounded memory of the pieces between spaces, so that each piece is encoded once."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator
from itertools import chain
from sys import getsizeof

import numpy as np
import pyarrow as pa
import regex

#: The split of byte-level BPE vocabularies before merges; a fixed value of the public format.
SPLIT = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


def split_special(text: str, special: dict[str, int]) -> Iterator[tuple[str, bool]]:
    """The stretches of a text and whether each is a special token; leftmost first, the longest at one place."""
    if not any(s in text for s in special):
        yield text, False
        return
    finder = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
    for i, part in enumerate(finder.split(text)):
        if part:
            yield part, i % 2 == 1


def pieces(text: str, special: dict[str, int]) -> list[str]:
    return [p for part, is_special in split_special(text, special) for p in ([part] if is_special else SPLIT.findall(part))]


def flat_ids(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids one after another, and how many each list has."""
    lengths = np.fromiter(map(len, lists), np.int32, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(lengths.sum())), lengths


#: What is known of a chunk: white space inside its borders, a full stop or comma first, a Latin letter or digit last.
OPEN, STOP, FIRM = 1, 2, 4


def _flags(chunk: str) -> int:
    bare = chunk[1:] if chunk[:1] in (" ", "\n") else chunk
    if not bare or bare.strip() != bare:
        return OPEN
    return (STOP if bare[0] in ".," else 0) | (FIRM if bare[-1] < "\u0250" and bare[-1].isalnum() else 0)


def give_back() -> None:
    """Returns memory that is free in this process to the system."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL("libc.so.6").malloc_trim(0)


class _Slots(dict):
    """Numbers chunks as they come, and lists those that are new."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self)
        self.new.append(chunk)
        return number


class PieceMemory:
    """Ids of pieces of text, each found once while it is remembered.

    ``encode_many`` gives the ids of distinct pieces, as lists or as :func:`flat_ids`. Once the memory holds more than ``bound`` pieces,
    or ``most_bytes`` of pieces and ids, only those seen more than once stay; results never depend on what it holds.
    """

    def __init__(self, encode_many: Callable[[list[str]], list[list[int]] | tuple[np.ndarray, np.ndarray]], bound: int = 200_000,
                 most_bytes: int = 96 << 20):
        self.encode_many, self.bound, self.most_bytes = encode_many, bound, most_bytes
        self.clear()

    def done(self) -> None:
        """Empties the memory at the end of a task and gives it back to the system: workers outlive the stage."""
        self.clear()
        give_back()

    def flags_of(self, pieces: list[str]) -> np.ndarray:
        return np.zeros(len(pieces), np.uint8)

    def clear(self) -> None:
        self.slot = _Slots()
        self.pool = np.zeros(1 << 16, np.int32)
        self.used = self.held = 0
        self.start, self.length, self.flags = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint8)
        self.seen = np.zeros(0, np.int32)

    def make_room(self) -> None:
        """Keeps the pieces seen more than once if the memory is full; all go if these are most of it."""
        if len(self.slot) <= self.bound and self.held + 4 * self.used <= self.most_bytes:
            return
        often = np.flatnonzero(self.seen > 1)
        names, pool, start, length, flags = list(self.slot), self.pool, self.start, self.length, self.flags
        self.clear()
        held = sum(map(getsizeof, map(names.__getitem__, often.tolist())))
        if len(often) > self.bound // 2 or held + 4 * int(length[often].sum()) > self.most_bytes // 2:
            return
        self.slot.update((names[i], k) for k, i in enumerate(often.tolist()))
        self.length, self.flags, self.seen, self.held = length[often], flags[often], np.ones(len(often), np.int32), held
        ends = np.cumsum(self.length, dtype=np.int64)
        self.start, self.used = ends - self.length, int(ends[-1]) if len(ends) else 0
        self.pool = pool[np.repeat(start[often] - self.start, self.length) + np.arange(self.used)]

    def _learn(self, new: list[str]) -> None:
        found = self.encode_many(new)
        ids, lengths = found if isinstance(found, tuple) else flat_ids(found)
        total = len(ids)
        if self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(max(total, self.used // 2) + 1024, np.int32)])
        self.pool[self.used : self.used + total] = ids
        starts = self.used + np.cumsum(lengths, dtype=np.int64) - lengths
        self.used += total
        self.held += sum(map(getsizeof, new))
        self.start, self.length = np.concatenate([self.start, starts]), np.concatenate([self.length, lengths])
        self.seen = np.concatenate([self.seen, np.zeros(len(new), np.int32)])
        self.flags = np.concatenate([self.flags, self.flags_of(new)])

    def slots_of(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all pieces one after another, and how many each list has."""
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        slots = np.fromiter(map(self.slot.__getitem__, chain.from_iterable(lists)), np.int32, int(counts.sum()))
        if self.slot.new:
            self._learn(self.slot.new)
            self.slot.new = []
        self.seen += np.bincount(slots, minlength=len(self.seen)).astype(np.int32)
        return slots, counts

    def ids_of(self, slots: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these pieces one after another, and how many each list has."""
        lengths = self.length[slots]
        ends = np.cumsum(lengths, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.pool[np.repeat(self.start[slots] - ends + lengths, lengths) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(bounds)


class ChunkEncoder(PieceMemory):
    """Ids of whole texts from ids of their chunks.

    A chunk begins at each space, line feed, full stop or comma. The split pattern never joins characters over such a border
    unless white space meets white space there, or a full stop or comma follows something else than a Latin letter or digit;
    texts where that happens are split by the pattern itself.
    """

    def __init__(self, encode_many: Callable[[list[str]], list[list[int]] | tuple[np.ndarray, np.ndarray]], special: dict[str, int],
                 bound: int = 200_000, most_bytes: int = 96 << 20):
        self.special = special
        super().__init__(encode_many, bound, most_bytes)

    def flags_of(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(_flags, pieces), np.uint8, len(pieces))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        lists = [
            pieces(t, self.special) if "\0" in t else t.replace(" ", "\0 ").replace("\n", "\0\n").replace(".", "\0.").replace(",", "\0,").split("\0")
            for t in texts
        ]
        self.make_room()
        slots, counts = self.slots_of(lists)
        flags = self.flags[slots]
        unsure = (flags & OPEN) > 0
        unsure[1:] |= ((flags[1:] & STOP) > 0) & ((flags[:-1] & FIRM) == 0)
        if unsure.any():
            ends = np.cumsum(counts)
            anew = np.unique(np.searchsorted(ends, np.flatnonzero(unsure), "right"))
            parts = np.split(slots, ends[:-1])
            others, counts[anew] = self.slots_of([pieces(texts[i], self.special) for i in anew.tolist()])
            for i, part in zip(anew.tolist(), np.split(others, np.cumsum(counts[anew])[:-1])):
                parts[i] = part
            slots = np.concatenate(parts)
        return self.ids_of(slots, counts)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of some ``rows``, so that few texts are Python strings at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def portions(texts: list, most: int = 400_000) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``most`` characters, at least one text each."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > most:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)
