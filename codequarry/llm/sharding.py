"""Shards of bounded size by extendible hashing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codequarry.llm.shared import broadcast_if_small, stored

#: Bits of the hash; deeper than that only equal keys are left together.
BITS = 60
#: Bits that sums go up by in one shuffle.
STRIDE = 8


def shards(docs: DataFrame, limit_bytes: int, id_column: str = "doc_id", text: str = "text", step: int = 6) -> DataFrame:
    """One row per document: its id, ``n_bytes`` (of the text in UTF-8; null: 0), ``shard`` and ``shard_bytes``.

    Documents hash by their id; a shard is a string of 0 and 1, the leading bits its documents share (empty: all of
    them). Buckets start with no bits; one that holds more than ``limit_bytes`` splits on its next bit, others stay. Bytes
    are summed by bits first and only these sums are worked on, ``step`` bits a round, until nothing is oversized. Where
    all bits are used up (equal ids, or ids whose hashes agree), a bucket continues on overflow pages, ``bits+1``,
    ``bits+2`` and so on, each within the limit. A single text above the limit is a shard of its own.

    A null id hashes like any other value; repeated rows share a bucket and count each. No documents: no rows. Only the
    id of ``docs`` is kept, so other columns cannot clash.
    """
    if limit_bytes < 1:
        raise ValueError("limit_bytes must be positive")
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long").alias("n_bytes"),
        F.conv(F.substring(F.md5(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("\0"))), 1, BITS // 4), 16, 10).cast("long").alias("hash"),
    )
    rows = stored(rows, "sharding")
    total = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    depth, directory, pending = 0, None, None
    if total > limit_bytes:
        depth = min(BITS, (total // limit_bytes).bit_length() + step)
    while True:
        cells = rows.withColumn("cell", F.shiftright("hash", BITS - depth))
        if pending is not None:  # only what no earlier depth could settle
            cells = cells.withColumn("up", F.shiftright("cell", depth - before)).join(pending, "up", "left_semi")
        sums = cells.groupBy("cell").agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs"))
        sums = _directory(sums, 0 if pending is None else before + 1, depth, limit_bytes)
        settled = sums.filter("leaf IS NOT NULL").select(
            F.lit(depth).alias("depth"), "cell", F.col("leaf.bits").alias("bits"), F.col("leaf.bytes").alias("shard_bytes"))
        directory = settled if directory is None else directory.unionByName(settled)
        open_ = sums.filter("leaf IS NULL")
        if depth == BITS or open_.isEmpty():
            break
        pending, before = open_.select(F.col("cell").alias("up")), depth
        depth = min(BITS, depth + step)
    directory = stored(directory, "sharding")
    entries, parts = directory.count(), []
    for (d,) in directory.select("depth").distinct().orderBy("depth").collect():
        own = broadcast_if_small(directory.filter(F.col("depth") == d).drop("depth"), entries)
        parts.append(rows.withColumn("cell", F.shiftright("hash", BITS - d)).join(own, "cell").select(
            F.col("id").alias(id_column), "n_bytes",
            F.substring(F.lpad(F.bin("hash"), BITS, "0"), F.lit(1), F.col("bits")).alias("shard"), "shard_bytes"))
    if depth == BITS:
        # row numbers are drawn in the scan of a written table, so a repeated task draws them again alike
        left = rows.withColumn("row", F.monotonically_increasing_id()).join(open_.select(F.col("cell").alias("hash")), "hash", "left_semi")
        parts.append(_overflow(stored(left, "sharding"), limit_bytes, id_column))
    out = parts[0] if parts else rows.select(F.col("id").alias(id_column), "n_bytes", F.lit("").alias("shard"), F.col("n_bytes").alias("shard_bytes"))
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _directory(sums: DataFrame, least: int, depth: int, limit_bytes: int) -> DataFrame:
    """``cell, leaf (bits, bytes)`` of the cells ``sums (cell, bytes, docs)`` of ``depth`` bits: the bucket of the fewest bits, at least
    ``least``, that holds the cell and fits; null if not even the cell does.

    Sums go upward, ``STRIDE`` bits at a time: each cell counts in its prefixes, and the shortest ones are the next cells. A bucket that
    fits below one that does not is a leaf, and leaves open up into their cells, so no group is larger than the answer.
    """
    levels, low, at = None, depth, sums
    while True:
        high = max(least, low - STRIDE)
        up = F.explode(F.sequence(F.lit(0 if levels is None else 1), F.lit(low - high)))
        step = stored(
            at.withColumn("up", up).groupBy((F.lit(low) - F.col("up")).alias("bits"), F.expr("shiftright(cell, up)").alias("prefix"))
            .agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs")), "sharding")
        levels = step if levels is None else levels.unionByName(step)
        at, low = step.filter(F.col("bits") == high).select(F.col("prefix").alias("cell"), "bytes", "docs"), high
        if low == least:
            break
    levels = levels.withColumn("fits", (F.col("bytes") <= limit_bytes) | (F.col("docs") == 1))
    above = levels.filter(~F.col("fits")).select((F.col("bits") + 1).alias("bits"), F.col("prefix").alias("parent"))
    fit = levels.filter("fits").withColumn("parent", F.shiftright("prefix", 1))
    leaves = fit.filter(F.col("bits") == least).unionByName(fit.filter(F.col("bits") > least).join(above, ["bits", "parent"], "left_semi"))
    wide = F.expr(f"shiftleft(1L, {depth} - bits)")
    opened = leaves.select(
        F.explode(F.sequence(F.col("prefix") * wide, (F.col("prefix") + 1) * wide - 1)).alias("cell"), F.struct("bits", "bytes").alias("leaf"))
    cells = levels.filter(F.col("bits") == depth).select(F.col("prefix").alias("cell"))
    return stored(cells.join(opened, "cell", "left"), "sharding")


def _overflow(rows: DataFrame, limit_bytes: int, id_column: str) -> DataFrame:
    """Pages for rows whose hashes all agree: rows are dealt to salts by their ``row`` numbers, and each salt fills pages up to the limit."""
    counts = rows.groupBy("hash").agg(F.sum(F.col("n_bytes") + 1).alias("all"))
    salts = F.greatest(F.ceil(F.col("all") / (4 * limit_bytes)), F.lit(1)).cast("long")
    dealt = rows.join(counts, "hash").withColumn("salt", F.pmod(F.xxhash64("row"), salts))
    order = Window.partitionBy("hash", "salt").orderBy("n_bytes", "row")
    # twice the limit holds any page that starts within a stretch of the limit, so halves of it never overflow
    dealt = stored(dealt.withColumn("before", F.sum("n_bytes").over(order.rowsBetween(Window.unboundedPreceding, -1)))
                   .withColumn("half", F.floor(F.coalesce("before", F.lit(0)) / F.greatest(F.lit(limit_bytes / 2), F.lit(1.0))).cast("long"))
                   .withColumn("big", F.when(F.col("n_bytes") * 2 > limit_bytes, F.col("row"))), "sharding")
    page = Window.partitionBy("hash", "salt", "half", "big")
    name = F.concat(F.lpad(F.bin("hash"), BITS, "0"), F.lit("+"), F.col("salt").cast("string"), F.lit("."), F.col("half").cast("string"),
                    F.coalesce(F.concat(F.lit("."), F.col("big").cast("string")), F.lit("")))
    return dealt.select(F.col("id").alias(id_column), "n_bytes", name.alias("shard"), F.sum("n_bytes").over(page).alias("shard_bytes"))


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, id_column: str = "doc_id") -> None:
    """Writes ``docs`` under ``path``, one folder ``shard=...`` with one file per shard. ``assigned`` comes from :func:`shards`;
    ids must be distinct and not null, as rows are told apart by them."""
    joined = docs.drop("shard").join(assigned.select(id_column, F.concat(F.lit("s"), "shard").alias("shard")), id_column)
    joined.repartition("shard").write.partitionBy("shard").parquet(path)
