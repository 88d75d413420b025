"""Mixing of sources to target weights by exact fitting of word budgets."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codequarry.llm.shared import broadcast_if_small, checkpointed, ship, word_count

#: Documents of one source and length that are ranked together; longer runs are split by ranges of their hashes.
RUN = 50_000


def targets(sizes: DataFrame, weights: Iterable[float] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """``source, source_size, weight, target`` for ``sizes(source, source_size)``, one row per source.

    Weights go to sources by code point, null last, and repeat. The total size is shared by weight; a target stops at
    ``most`` times its source's size, and what is over is shared again by weight among the others until none is above.
    Sources rank by a sort split over tasks; the rounds below read sums only. Sources without words get target 0.
    """
    weights = [float(w) for w in weights]
    ranked = _ranks(sizes)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = checkpointed(ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most))))
    total = float(table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    level = 0.0
    while total > 0:
        capped = F.col("cap") <= F.col("weight") * F.lit(level)
        full, open_weight = table.agg(F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0.0)),
                                      F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0))).first()
        risen = (total - full) / open_weight if open_weight else level
        if risen <= level:
            break
        level = risen
    return table.select("source", "source_size", "weight",
                        F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def _ranks(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``rank`` from 0 by source, null last. Ranges of sources are counted, then each ranks its own."""
    spread = checkpointed(sizes.withColumn("none", F.col("source").isNull()).repartitionByRange("none", "source")
                          .withColumn("part", F.spark_partition_id()))
    counts = sorted(spread.groupBy("part").count().collect())  # one row per task
    begin, before = {}, 0
    for part, n in counts:
        begin[part], before = before, before + n
    first = F.element_at(F.create_map(*[F.lit(x) for kv in begin.items() for x in kv]), F.col("part")) if begin else F.lit(0)
    rank = F.row_number().over(Window.partitionBy("part").orderBy("none", "source"))
    return spread.withColumn("rank", first + rank - 1).drop("none", "part")


def fit(sizes: np.ndarray, counts: np.ndarray, budget: float, reach: int = 1 << 16) -> np.ndarray:
    """How many documents of each size to take so that their sum comes as near to ``budget`` as it can.

    An even share of every size first; what is left is filled from large to small, except that documents worth about
    ``reach`` are handed back, and a bounded-knapsack table over the sums up to ``reach`` finds the nearest sum for them.
    If the sum is not met so, the sums of long documents (over half of ``reach``) are listed, and the nearest of these
    together with what the others can add is taken: exactly the nearest if the others hold at most four times ``reach`` words
    and the long ones have at most 16,384 sums; beyond that, long sums are thinned evenly and the others fill what is left.
    """
    order = np.argsort(-sizes, kind="stable")
    s, c = sizes[order].astype(np.int64), counts[order].astype(np.int64)
    whole = int((s * c).sum())
    if whole == 0 or budget <= 0:
        return np.zeros(len(sizes), np.int64)
    take = np.minimum(c, np.floor(c * min(1.0, budget / whole)).astype(np.int64))
    n_long, table = int((s > reach // 2).sum()), 4 * reach
    best = _completed(s, c, take, budget, reach)
    off = lambda t: abs(budget - int((s * t).sum()))
    if off(best) >= 0.5:
        short = int((s * c)[n_long:].sum())
        fixed, sums, levels = _long_sums(s[:n_long], c[:n_long], take[:n_long], budget)
        near = np.maximum(np.maximum(sums - budget, budget - short - sums), 0)
        none = np.where(np.arange(len(s)) < n_long, 0, c)
        if short <= table:  # every sum of the short ones, so the best of all pairs
            ends = _nearest(s, none, -1.0, short, every=True)
            wanted = budget - sums
            right = np.clip(np.searchsorted(ends, wanted), 0, len(ends) - 1)
            near = np.minimum(np.abs(ends[right] - wanted), np.abs(ends[np.maximum(right - 1, 0)] - wanted))
        for k in np.argsort(near, kind="stable")[: 1 if short <= table else 64]:
            trial = take.copy()
            trial[:n_long] = _long_counts(fixed, levels, int(sums[k]), s[:n_long])
            if short <= table:
                trial[n_long:] = 0
                trial += _nearest(s, none, budget - int(sums[k]), short)
            else:
                trial = _completed(s, c, trial, budget, reach, n_long)
            if off(trial) < off(best):
                best = trial
            if off(best) < 0.5:
                break
    out = np.zeros(len(sizes), np.int64)
    out[order] = best
    return out


def _long_sums(s: np.ndarray, c: np.ndarray, take: np.ndarray, budget: float, most: int = 1 << 14) -> tuple[np.ndarray, np.ndarray, list]:
    """Sums of documents in no table, with what :func:`_long_counts` needs: counts that are fixed, sums in rising order, and
    the sums before each step with its size index and copies. All sums are kept while they are ``most`` or fewer, then one
    in each of ``most`` equal ranges. Of more than 1,024 steps the middle sizes keep their even share."""
    steps = []
    for i in range(len(s)):
        n, k = int(c[i]), 1
        while n > 0:
            steps.append((i, min(k, n)))
            n, k = n - min(k, n), 2 * k
    fixed = np.zeros(len(s), np.int64)
    if len(steps) > 1024:
        free = {i for i, _ in steps[:512] + steps[-512:]}
        fixed = np.array([0 if i in free else take[i] for i in range(len(s))])
        steps = [x for x in steps if x[0] in free]
    highest = budget + int(s.max(initial=0))  # the nearest sum from above lies below this
    sums, levels = np.array([int((s * fixed).sum())]), []
    for i, copies in steps:
        levels.append((sums, i, copies))
        grown = sums + copies * int(s[i])
        sums = np.union1d(sums, grown[grown <= highest])
        if len(sums) > most:
            width = (int(sums[-1]) - int(sums[0])) // most + 1
            sums = sums[np.unique((sums - sums[0]) // width, return_index=True)[1]]
    return fixed, sums, levels


def _long_counts(fixed: np.ndarray, levels: list, total: int, s: np.ndarray) -> np.ndarray:
    """Documents of each long size that make up ``total``, one of the sums after the last level."""
    counts = fixed.copy()
    for sums, i, copies in reversed(levels):
        at = np.searchsorted(sums, total)
        if at == len(sums) or sums[at] != total:
            counts[i] += copies
            total -= copies * int(s[i])
    return counts


def _completed(s: np.ndarray, c: np.ndarray, take: np.ndarray, budget: float, reach: int, start: int = 0) -> np.ndarray:
    """``take`` brought near the budget by sizes (falling) from place ``start`` on: what is over is handed back and what is
    left is filled, both from large to small, then the table finds the nearest sum for documents worth about ``reach``."""
    take = take.copy()
    left = budget - int((s * take).sum())
    for i in range(start, len(s) if left < 0 else 0):
        back = int(min(take[i], -left // s[i] + 1))
        take[i] -= back
        left += back * int(s[i])
        if left >= 0:
            break
    for i in range(start, len(s)):
        more = int(min(c[i] - take[i], left // s[i]))
        if more > 0:
            take[i] += more
            left -= more * int(s[i])
    # hand back small documents, which make the finest sums
    for i in range(len(s) - 1, start - 1, -1):
        back = int(min(take[i], max(0, (reach // 2 - left) // s[i])))
        take[i] -= back
        left += back * int(s[i])
    goal = int(min(reach, left + int(s[start]))) if start < len(s) else 0
    if goal > 0:
        take += _nearest(s, np.where(np.arange(len(s)) < start, 0, c - take), left, goal)
    return take


def _nearest(sizes: np.ndarray, counts: np.ndarray, wanted: float, goal: int, every: bool = False) -> np.ndarray:
    """Counts whose sum, at most ``goal``, is nearest to ``wanted``; the smaller sum wins a tie. ``every``: all sums instead."""
    used = np.full(goal + 1, -1, np.int64)  # size index that first reached a sum; -2 at 0
    used[0] = -2
    best, steps = int(round(wanted)), []
    for i in np.flatnonzero((counts > 0) & (sizes <= goal))[::-1]:
        size = int(sizes[i])
        spent = np.where(used != -1, 0, goal + 1)  # copies of this size in each sum
        for multiple in range(int(min(counts[i], goal // size))):
            free = np.flatnonzero((spent[:-size] == multiple) & (used[:-size] != -1) & (used[size:] == -1)) + size
            if not len(free):
                break
            used[free], spent[free] = i, multiple + 1
        steps.append(i)
        if not every and 0 <= best <= goal and used[best] != -1:
            break
    sums = np.flatnonzero(used != -1)
    if every:
        return sums
    at = int(sums[np.argmin(np.abs(sums - wanted))])
    take = np.zeros(len(sizes), np.int64)
    while used[at] != -2:
        take[used[at]] += 1
        at -= int(sizes[used[at]])
    return take


def mix(docs: DataFrame, weights: Iterable[float] = (1, 2, 3), most: int = 3, seed: int = 0, id_column: str = "doc_id",
        text: str = "text", source: str = "source") -> DataFrame:
    """``doc`` (a struct of all columns of ``docs``), ``size``, ``source_size``, ``target`` and ``copies`` of each row.

    Size is the number of words (null: 0); :func:`targets` says what each source should give. A source first gives all
    its documents as often as its target holds them whole. For the rest its documents are counted by exact size,
    :func:`fit` says how many of each size to take, and those with the smallest seeded hashes of id and text are taken,
    so reruns agree. ``copies`` says how often a document is taken, ``most`` times or less; sizes times copies come within
    a few words of the target wherever the sizes allow it.

    Rows are never gathered by source. Runs of one size are ranked by ranges of the hash, and each row then compares its
    own hash with the last one taken of its source and size, so texts are not shuffled while these limits are few.
    Documents without words, and all of a source that has none, are taken 0 times. Rows that agree in id and text have
    one hash and are taken together. A null source is a source; null ids are one id. No documents: no rows.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{source}`").alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"), _draw(F.col(f"`{id_column}`"), F.col(f"`{text}`"), seed).alias("draw"),
    )
    ship(docs.sparkSession)
    slim = checkpointed(rows.select("source", "size", "draw"))
    lengths = slim.groupBy("source", "size").agg(F.count("*").alias("n"))
    per_source = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = checkpointed(targets(per_source, weights, most))

    def plan(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sizes, counts = rows["size"].to_numpy(), rows["n"].to_numpy()
        total, target = float(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
        whole = min(most, int(target // total)) if total else 0
        take = fit(sizes, counts, target - whole * total) if whole < most and total else np.zeros(len(sizes), np.int64)
        return pd.DataFrame({"source": rows["source"], "size": sizes, "n": counts, "whole": whole, "take": take})

    # one row per distinct size of a source, not per document; documents without words need no plan
    with_goals = lengths.filter("size > 0").join(goals, lengths["source"].eqNullSafe(goals["source"])).select(
        lengths["source"], "size", "n", "source_size", "target")
    plans = checkpointed(with_goals.groupBy("source").applyInPandas(plan, "source string, size long, n long, whole long, take long"))
    n_plans = plans.count()
    partial = plans.filter("take > 0 AND take < n").withColumn("parts", F.ceil(F.col("n") / RUN))
    own = slim.alias("s").join(broadcast_if_small(partial, n_plans).alias("p"),
                               F.col("s.source").eqNullSafe(F.col("p.source")) & (F.col("s.size") == F.col("p.size")))
    # hashes are even over the long range, so equal ranges hold about RUN rows each
    part = F.floor((F.col("draw").cast("double") / 2.0**64 + 0.5) * F.col("parts")).cast("long")
    own = own.select("s.source", "s.size", "draw", "take", F.when(F.col("parts") == 1, 0).otherwise(part).alias("part"))
    counted = own.groupBy("source", "size", "part", "take").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("source", "size").orderBy("part"))
    edge = counted.withColumn("before", upto - F.col("n")).filter("before < take AND take <= before + n").select(
        "source", "size", "part", (F.col("take") - F.col("before")).alias("nth"))
    ranked = own.drop("take").alias("o").join(edge.alias("e"), F.col("o.source").eqNullSafe(F.col("e.source"))
                                              & (F.col("o.size") == F.col("e.size")) & (F.col("o.part") == F.col("e.part")))
    ranked = ranked.select("o.source", "o.size", "o.part", "draw", "nth").withColumn(
        "rank", F.row_number().over(Window.partitionBy("source", "size", "part").orderBy("draw")))
    last = ranked.filter("rank = nth").select("source", "size", F.col("draw").alias("last"))
    limits = plans.alias("a").join(last.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.size") == F.col("b.size")), "left")
    limits = checkpointed(limits.select(
        F.col("a.source").alias("of"), F.col("a.size").alias("long"), "whole",
        F.when(F.col("take") == F.col("n"), F.lit(2**63 - 1)).when(F.col("take") > 0, F.col("last")).alias("last")))
    named = goals.select(F.col("source").alias("goal_of"), "source_size", "target")
    taken = F.coalesce(F.col("whole"), F.lit(0)) + F.when(F.col("draw") <= F.col("last"), 1).otherwise(0)
    return rows.join(broadcast_if_small(named, goals.count()), F.col("source").eqNullSafe(F.col("goal_of")), "left").join(
        broadcast_if_small(limits, n_plans), F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("long")), "left"
    ).select("doc", "size", "source_size", "target", taken.cast("long").alias("copies"))


def _draw(id_: Column, text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), id_, F.xxhash64(text))
