"""Product codes of vectors in whole numbers: nearest entries by early elimination in the Walsh-Hadamard domain."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry.llm.shared import broadcast_if_small, ship, stored

#: Sums travel in limbs of so many bits, so that no total of any number of rows overflows.
LIMB = 48


def sequency_order(size: int) -> list[int]:
    """The rows of a Hadamard matrix of ``size`` (a power of two), by how often their sign changes."""
    signs = [[(-1) ** (i & j).bit_count() for j in range(size)] for i in range(size)]
    return sorted(range(size), key=lambda i: sum(a != b for a, b in zip(signs[i], signs[i][1:])))


def transformed(rows: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, zero-padded to a power of two, in sequency order. Whole numbers only; a
    squared distance of two rows is that of their transforms divided by the padded length."""
    size = 1 << max(0, rows.shape[1] - 1).bit_length()
    x = np.concatenate([rows, np.zeros((len(rows), size - rows.shape[1]), rows.dtype)], axis=1)
    step = 1
    while step < size:
        pairs = x.reshape(len(x), size // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), size)
        step *= 2
    return x[:, sequency_order(size)]


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry for each row (ties to the lower index) and the squared distance, exactly.

    The first coefficient orders the entries; the whole distance to the best of them is a bound. Then coefficients are added
    in sequency order, and an entry goes as soon as its sum so far is above the bound: sums only grow, so it cannot be nearest.
    """
    x, c = transformed(rows), transformed(entries)
    n, size = x.shape
    start = (x[:, :1] - c[None, :, 0]) ** 2
    guess = np.argmin(start, axis=1)
    bound = ((x - c[guess]) ** 2).sum(axis=1)
    row, entry = np.nonzero(start <= bound[:, None])
    total = start[row, entry]
    for k in range(1, size):
        total = total + (x[row, k] - c[entry, k]) ** 2
        alive = total <= bound[row]
        row, entry, total = row[alive], entry[alive], total[alive]
    # pairs stand by row, then entry: a stable sort by distance within the row puts the lowest index first
    order = np.lexsort((entry, total, row)) if total.dtype != object else np.array(
        sorted(range(len(row)), key=lambda i: (row[i], total[i], entry[i])), np.int64)
    first = order[np.searchsorted(row[order], np.arange(n))] if n else order
    return entry[first], total[first] // size


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``, as 64-bit numbers, or as Python's own where these do not hold them."""
    if not len(values) or np.abs(values).max() < 2**62 / scale:
        return np.floor(values * scale).astype(np.int64)
    return np.array([math.floor(x) * scale if abs(x) >= 2**53 else math.floor(x * scale) for x in values.tolist()], object)


def _matrix(vectors: pa.Array, width: int, scale: int) -> np.ndarray:
    """The vectors of a batch as rows of whole numbers, zero-padded to ``width``."""
    flat = whole_numbers(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64), scale)
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(vectors), width), flat.dtype)
    row = np.repeat(np.arange(len(vectors)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _fitting(rows: np.ndarray, books: list[list[list[int]]], part: int) -> np.ndarray:
    """A codebook in the kind of number that keeps sums of squared differences with ``rows`` exact."""
    largest = max(abs(v) for e in books[part] for v in e) + (max(abs(int(rows.max())), abs(int(rows.min()))) if rows.size else 0)
    return np.array(books[part], np.int64 if largest < 2**31 >> max(0, rows.shape[1] - 1).bit_length() else object)


def _assigned(rows: np.ndarray, books: list[list[list[int]]], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for part in range(len(books)):
        own = rows[:, part * width : (part + 1) * width]
        entries = _fitting(own, books, part)
        yield (own, *nearest(own if own.dtype == entries.dtype else own.astype(object), entries))


def _sums(rows: DataFrame, books: list[list[list[int]]], width: int, scale: int) -> list[list[list[int]]]:
    """One round: the codebooks with each entry replaced by the floored mean of the parts it is nearest to."""
    parts, entries = len(books), len(books[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), object)
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                matrix = _matrix(batch.column(0).slice(first, 4096), parts * width, scale)
                for p, (own, index, _) in enumerate(_assigned(matrix, books, width)):
                    counts[p] += np.bincount(index, minlength=entries)
                    for e in np.unique(index):
                        sums[p, e] += own[index == e].sum(axis=0)
        out = []
        for p in range(parts):
            for e in np.flatnonzero(counts[p]).tolist():
                out.append((p, e, -1, 0, int(counts[p, e])))
                for i, value in enumerate(sums[p, e].tolist()):
                    size, sign, limb = abs(int(value)), 1 if value >= 0 else -1, 0
                    while size:
                        out.append((p, e, i, limb, sign * (size & ((1 << LIMB) - 1))))
                        size, limb = size >> LIMB, limb + 1
        columns = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int32()) for c in columns[:4]), pa.array(columns[4], pa.int64())], ["part", "entry", "place", "limb", "value"])

    # parts x entries x positions, whatever the number of vectors
    found = rows.select("v").mapInArrow(run, "part int, entry int, place int, limb int, value long").groupBy(
        "part", "entry", "place", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    totals: dict[tuple[int, int, int], int] = {}
    for r in found:
        key = (r["part"], r["entry"], r["place"])
        totals[key] = totals.get(key, 0) + (int(r["value"]) << (LIMB * r["limb"]))
    return [[[totals.get((p, e, i), 0) // totals[p, e, -1] for i in range(width)] if (p, e, -1) in totals else books[p][e]
             for e in range(entries)] for p in range(parts)]


def books_digest(books: list[list[list[int]]]) -> str:
    """SHA-256 of all components by part, entry and position, in decimal, joined by commas."""
    return hashlib.sha256(",".join(str(v) for book in books for entry in book for v in entry).encode()).hexdigest()


def vector_codes(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, id_column: str = "vec_id",
                 vector: str = "embedding", label: str = "label") -> tuple[DataFrame, list[list[list[int]]]]:
    """One row per usable row of ``vectors``: its id, ``code`` (two hex digits per part), ``error`` (squared distances to the entries,
    summed), ``label_error`` (errors summed over equal labels, nulls together); and the codebooks, by part and entry.

    Components become whole numbers, ``floor(scale * x)``, and vectors are cut into ``parts`` equal parts. The codebook of a part
    starts as that part of the ``entries`` smallest ids; each round assigns all parts to their nearest entries and
    replaces these by floored means. Everything is whole numbers: results do not depend on how rows are dealt. Tasks return
    sums by part and entry, so a round sends a fixed number of rows, however many vectors fall on one entry.

    Rows whose vector is null or holds null or non-finite components are left out. Vectors shorter than the longest one, or
    one whose length is no multiple of ``parts``, are filled up with zeros; an empty vector is all zeros. Repeated ids are
    ordered by their vectors, null ids stand last; fewer rows than entries give fewer entries. Errors beyond a long are null, as is
    the label error of a label that holds one.
    No rows: no rows, and no codebooks. Other columns are not read.
    """
    if not 1 <= entries <= 256 or parts < 1 or scale < 1 or scale & (scale - 1) or rounds < 0:
        raise ValueError("entries must be 1 to 256, parts at least 1, rounds at least 0, and scale a power of two")
    ship(vectors.sparkSession)
    v = F.col("v")
    finite = ~F.coalesce(F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True))
    rows = stored(vectors.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("v"))
                  .filter(v.isNotNull() & finite), "vectors")
    length = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(1, math.ceil(length / parts))
    seeds = rows.orderBy(F.asc_nulls_last("id"), "v").limit(entries).select("v").toArrow().column("v").combine_chunks()
    whole = _matrix(seeds, parts * width, scale).tolist() if len(seeds) else []
    books = [[[int(x) for x in r[p * width : (p + 1) * width]] for r in whole] for p in range(parts)] if whole else []
    for _ in range(rounds if books else 0):
        books = _sums(rows, books, width, scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows if books else 0, 4096):
                some = batch.slice(first, 4096)
                found = [(index, far) for _, index, far in _assigned(_matrix(some.column(2), parts * width, scale), books, width)]
                codes = [bytes(c).hex() for c in np.stack([i for i, _ in found], axis=1).astype(np.uint8)]
                errors = [int(sum(e)) for e in zip(*(far.tolist() for _, far in found))]
                yield pa.RecordBatch.from_arrays([*some.columns[:2], pa.array(codes), pa.array(
                    [e if e < 2**63 else None for e in errors], pa.int64())], ["id", "label", "code", "error"])

    coded = rows.mapInArrow(run, T.StructType([*rows.schema[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]))
    coded = stored(coded, "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long")
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.when(F.count("error") == F.count("*"), total).alias("label_error"))
    sums = broadcast_if_small(sums, sums.count())
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(id_column), "code", "error", "label_error"), books
