"""Near duplicates of texts by SimHash fingerprints, joined through a binary trie."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry.llm.bpe import release
from codequarry.llm.components import components
from codequarry.llm.shared import checkpointed, ship, stored

#: Fingerprints in a leaf of the part of the trie that is dealt to tasks.
LEAF = 8192
STEP = 3


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """A bit is 1 if set in over half of the XXH64 hashes of the text's shingles; 0 for a text without words."""
    parts = text.lower().split()  # on bytes: A-Z and the six ASCII white space characters
    if not parts:
        return 0
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    ends = np.cumsum(lengths) - 1
    begins = ends - lengths + 1
    n = max(1, len(parts) - words + 1)
    begins, ends = begins[:n], ends[-n:]
    votes = np.zeros(64, np.int64)
    for first in range(0, n, 1 << 16):
        cut = slice(first, first + (1 << 16))
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(begins[cut].tolist(), ends[cut].tolist())], ">u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """All columns but the text, and ``fp``: the fingerprint as a signed long. Null counts as the empty text."""
    rest = [c for c in docs.columns if c not in (text, "fp")]
    ship(docs.sparkSession)
    slim = docs.select(*[F.col(f"`{c}`") for c in rest], F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            values = [fingerprint(t.as_py(), words, seed) for t in batch.column(len(rest))]
            found = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], found], [*rest, "fp"])

    return slim.mapInArrow(run, T.StructType([*slim.drop(text).schema, T.StructField("fp", T.LongType())]))


def trie_pairs(left: np.ndarray, right: np.ndarray, depth: int, budget: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sorted, distinct fingerprints (uint64) that differ in ``budget`` bits at most.

    Walks node pairs of the two tries down together, a level at a time. A node is a range of the sorted array. Each step
    splits both nodes on the next bit; pairs of unlike children have one more bit of difference, and are dropped beyond
    the budget. Pairs of few members are compared directly. ``depth`` bits are known to be used up by the caller.
    With ``same``, both are one trie, and each pair comes once.
    """
    la, ha, lb, hb, err = (np.array([x], np.int64) for x in (0, len(left), 0, len(right), 0))
    out_a, out_b = [], []
    for bit in range(63 - depth, -1, -1):
        few = (ha - la) * (hb - lb) <= 64
        if few.any():
            a, b = _products(la[few], ha[few], lb[few], hb[few])
            near = np.bitwise_count(left[a] ^ right[b]) <= budget
            out_a.append(a[near])
            out_b.append(b[near])
            la, ha, lb, hb, err = (x[~few] for x in (la, ha, lb, hb, err))
        if not len(la):
            break
        one = np.uint64(1 << bit)
        high = ~np.uint64((1 << (bit + 1)) - 1)
        ma = np.clip(np.searchsorted(left, (left[la] & high) | one), la, ha)
        mb = np.clip(np.searchsorted(right, (right[lb] & high) | one), lb, hb)
        nodes = [(la, ma, lb, mb, err), (ma, ha, mb, hb, err), (la, ma, mb, hb, err + 1), (ma, ha, lb, mb, err + 1)]
        if same:  # the mirror of a pair of unlike children of one node
            nodes[3] = tuple(np.where((la == lb) & (ha == hb), 0, x) for x in nodes[3])
        la, ha, lb, hb, err = (np.concatenate(x) for x in zip(*nodes))
        stay = (ha > la) & (hb > lb) & (err <= budget)
        la, ha, lb, hb, err = (x[stay] for x in (la, ha, lb, hb, err))
    if len(la):
        a, b = _products(la, ha, lb, hb)
        out_a.append(a)
        out_b.append(b)
    a, b = np.concatenate(out_a or [la]), np.concatenate(out_b or [lb])
    return (a[a < b], b[a < b]) if same else (a, b)


def _products(la: np.ndarray, ha: np.ndarray, lb: np.ndarray, hb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = (ha - la) * (hb - lb)
    ends = np.cumsum(sizes)
    at = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)
    width = np.repeat(hb - lb, sizes)
    return np.repeat(la, sizes) + at // np.maximum(width, 1), np.repeat(lb, sizes) + at % np.maximum(width, 1)


def _leaves(fps: DataFrame, total: int, leaf: int) -> DataFrame:
    """``fp, depth, node``: each fingerprint's trie leaf, a prefix of ``depth`` bits with at most ``leaf`` fingerprints.

    All leaves begin at the depth that even hashes would need; only those still too full go ``STEP`` bits deeper, round
    by round. Fingerprints are distinct, so 64 bits always end it."""
    depth = max(0, min(60, (total // leaf).bit_length()))
    done, open_ = None, fps
    while True:
        prefix = F.shiftrightunsigned("fp", 64 - depth) if depth else F.lit(0).cast("long")
        placed = open_.withColumn("depth", F.lit(depth)).withColumn("node", prefix)
        full = checkpointed(placed.groupBy("node").agg(F.count("*").alias("n")).filter(F.col("n") > leaf).select("node"))
        if depth >= 64 or full.isEmpty():
            return placed if done is None else done.unionByName(placed)
        closed = placed.join(full, "node", "left_anti").select("fp", "depth", "node")
        done = closed if done is None else done.unionByName(closed)
        open_ = placed.join(full, "node", "left_semi").select("fp")
        depth = min(64, depth + STEP)


def near_fingerprints(fps: DataFrame, budget: int = 2, leaf: int = LEAF) -> DataFrame:
    """Edges ``a, b`` that connect distinct fingerprints (column ``fp``) within ``budget`` bits; a spanning set of all such links.

    The trie's leaves (:func:`_leaves`) are packed into one row each. Pairs of leaves whose prefixes differ in few enough bits
    are found by a join on flipped prefixes, so a leaf meets a number of others that depends on depth and budget, not on
    the data. Each such pair is a row on its own, walked by :func:`trie_pairs`, with no more than two leaves in memory.
    """
    ship(fps.sparkSession)
    total = fps.count()
    leaves = stored(_leaves(fps, total, leaf).groupBy("depth", "node").agg(F.sort_array(F.collect_list("fp")).alias("fps")), "leaves")
    nodes = checkpointed(leaves.select("depth", "node"))
    depths = sorted(r[0] for r in nodes.select("depth").distinct().collect())  # at most 64 numbers
    ups = [nodes.filter(F.col("depth") >= d).select(
        F.lit(d).alias("level"), F.expr(f"shiftrightunsigned(node, depth - {d})").alias("prefix"),
        F.col("depth").alias("depth2"), F.col("node").alias("node2")) for d in depths]
    flips = []
    for d in depths:
        masks = [sum(1 << b for b in bits) for n in range(budget + 1) for bits in _choices(d, n)]
        # as many masks as choices of few bits among the depth: 1 + d + d(d-1)/2 for two
        table = fps.sparkSession.createDataFrame([(m - (1 << 64) if m >= 1 << 63 else m,) for m in masks], "mask long")
        flips.append(nodes.filter(F.col("depth") == d).crossJoin(F.broadcast(table)).select(
            F.col("depth").alias("level"), F.expr("node ^ mask").alias("prefix"), "depth", "node"))
    left, right = flips[0], ups[0]
    for x, y in zip(flips[1:], ups[1:]):
        left, right = left.unionByName(x), right.unionByName(y)
    pairs = left.join(right, ["level", "prefix"]).filter("depth < depth2 OR node <= node2").select("depth", "node", "depth2", "node2")
    met = pairs.join(leaves, ["depth", "node"]).join(
        leaves.select(F.col("depth").alias("depth2"), F.col("node").alias("node2"), F.col("fps").alias("fps2")), ["depth2", "node2"]
    ).select((F.expr("depth = depth2 AND node = node2")).alias("same"), "fps", "fps2")
    # by content, not by node: rows are as even as leaves are
    met = met.repartition(F.xxhash64("fps", "fps2"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i in range(batch.num_rows):
                one, two = (np.sort(batch.column(k)[i].values.to_numpy().view(np.uint64)) for k in (1, 2))
                a, b = trie_pairs(one, two, 0, budget, batch.column(0)[i].as_py())
                found_a.append(one[a].view(np.int64))
                found_b.append(two[b].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found_a)), pa.array(np.concatenate(found_b))], ["a", "b"])

    return met.mapInArrow(run, "a long, b long")


def _choices(n: int, k: int) -> Iterator[tuple[int, ...]]:
    from itertools import combinations

    return combinations(range(n), k)


def simhash_groups(docs: DataFrame, budget: int = 2, words: int = 3, seed: int = 42, id_column: str = "doc_id",
                   text: str = "text", leaf: int = LEAF) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Texts are lower-cased (A-Z), cut into words and shingles of ``words`` words with repeats (fewer words: the whole
    sequence is one); fingerprints within ``budget`` bits link; ``component_id`` is the smallest id reachable by links.
    Equal fingerprints are one node, so copies are never paired, and a fingerprint has only so many others within the
    budget, which bounds links by the nodes.

    Null or empty texts have fingerprint 0, which links like any other. Repeated rows and null ids share their group, whose
    smallest non-null id is taken (null if it has none). No documents: no rows. Other columns are dropped.
    """
    rows, named = _groups(docs, budget, words, seed, id_column, text, leaf)
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named.join(least, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, budget: int = 2, words: int = 3, seed: int = 42, id_column: str = "doc_id",
                text: str = "text", leaf: int = LEAF) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their group of :func:`simhash_groups`: the one of smallest id (null last;
    among equal ids, of the smallest text hash). Of rows equal in id and text one stays."""
    rows, named = _groups(docs, budget, words, seed, id_column, text, leaf)
    order = F.struct(F.col("id").isNull().alias("none"), "id", "th")
    least = rows.groupBy("fp").agg(F.min(order).alias("least"))
    first = least.join(named.select("fp", "root"), "fp").groupBy("root").agg(F.min("least").alias("least")).select(
        F.col("least.id").alias("kept_id"), F.col("least.th").alias("kept_th"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{id_column}`").alias("id"),
                         F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("th"))
    stay = packed.join(first, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("th") == F.col("kept_th")), "left_semi")
    return stay.dropDuplicates(["id", "th"]).select("doc.*")


def _groups(docs: DataFrame, budget: int, words: int, seed: int, id_column: str, text: str, leaf: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``id, th, fp``, and ``fp, least, root`` for each fingerprint: its smallest id and the smallest one it can reach."""
    slim = docs.select(F.col(f"`{id_column}`").alias("id"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("th"),
                       F.col(f"`{text}`").alias("text"))
    rows = stored(fingerprints(slim, "text", words, seed), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    groups = components(near_fingerprints(distinct.select("fp"), budget, leaf)) if not distinct.isEmpty() else distinct.selectExpr(
        "fp AS node", "fp AS root")
    return rows, distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
