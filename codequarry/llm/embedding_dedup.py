"""Near duplicates among embeddings: an exact metric range join over pivot cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codequarry.llm.components import components
from codequarry.llm.shared import checkpointed, ship, stored

#: Rows of a block; two blocks meet in one task.
BLOCK = 2048
#: Most pivots of one label; beyond it cells get more blocks.
PIVOTS = 128
#: Slack of the triangle inequality for rounding.
SLACK = 1e-6


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps squares of very large or small components finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def embedding_links(vectors: DataFrame, threshold: float = 0.93, id_column: str = "vec_id", vector: str = "embedding",
                    label: str = "label", block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """One row per vector: its id, ``n_links``, ``component_id`` and ``kept``; links join equal labels at cosine ``threshold`` up.

    On unit vectors, cosine ``c`` is distance ``sqrt(2 - 2c)``: a range join. Equal vectors of a label are one point
    first. A label with more than ``block`` points gets about one pivot per block (points picked by their hash, ``pivots``
    at most); each point lives in the cell of its nearest pivot ``p`` and is a guest in every cell ``q`` with
    ``d(x,q) - d(x,p) <= 2r`` whose border plane is also within ``r``, where the triangle inequality lets a partner live. Cells join
    independently. A cell deals its points to blocks and joins residents' blocks with all blocks in it, so a task holds two
    blocks, however full a cell is. Tasks return how many links each resident has and a spanning set of links, never the pairs.
    Where vectors have no near neighbours to tell cells apart, guests are many and the work is that of the blocks.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do null labels or vectors of
    different lengths; each is its own component. Ids must be distinct integers: rows with a null id are returned with
    null ``component_id`` and count in nobody's links. Repeated rows with one id count as copies of it. No rows: no rows.
    Other columns are dropped.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    radius = float(np.sqrt(2 - 2 * threshold))
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("v"))
    rows = rows.withColumn("v", F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double"))))
    whole = F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & ~F.coalesce(F.exists(
        "v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True)) & F.exists("v", lambda x: x != 0)
    rows = stored(rows.withColumn("usable", F.coalesce(whole, F.lit(False))).withColumn(
        "v", F.when(F.col("usable"), F.col("v"))), "embeddings")
    points = stored(
        rows.filter("usable").groupBy("label", F.size("v").alias("dim"), "v").agg(F.min("id").alias("point"), F.count("*").alias("n")),
        "points")
    sizes = points.groupBy("label", "dim").agg(F.count("*").alias("points"))
    large = checkpointed(sizes.filter(F.col("points") > block).withColumn("chunks", F.ceil(F.col("points") / block)))
    picked = _pivots(points, large, pivots)

    # chunks of a label's points meet all of its pivots
    ship(vectors.sparkSession)
    spread = points.join(large, ["label", "dim"]).withColumn("chunk", F.pmod(F.xxhash64("point"), "chunks")).drop("points", "chunks")
    everywhere = picked.join(large, ["label", "dim"]).select(
        *_fresh("label", "dim", "number", "v"), F.explode(F.sequence(F.lit(0), F.col("chunks").cast("int") - 1)).alias("chunk"))

    def settle(own: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return pd.DataFrame({"point": [], "cell": [], "home": []})
        if not len(centres):
            return pd.DataFrame({"point": own["point"], "cell": 0, "home": True})
        x, p = _unit(own["v"]), _unit(centres.sort_values("number")["v"])
        dots = x @ p.T
        near = np.sqrt(np.maximum(0, 2 - 2 * dots))
        home = np.argmax(dots, axis=1)
        mine = np.arange(len(x))
        gaps = np.sqrt(np.maximum(0, 2 - 2 * p @ p.T))[home]
        plane = (dots[mine, home][:, None] - dots) / np.where(gaps > 0, gaps, 1)
        guest = (near - near[mine, home][:, None] <= 2 * radius + SLACK) & (plane <= radius + SLACK)
        guest[mine, home] = True
        at, cell = np.nonzero(guest)
        return pd.DataFrame({"point": own["point"].to_numpy()[at], "cell": cell, "home": home[at] == cell})

    settled = spread.groupBy("label", "dim", "chunk").cogroup(everywhere.groupBy("label", "dim", "chunk")).applyInPandas(
        settle, "point long, cell int, home boolean")
    placed = points.join(settled, "point", "left").select(
        "label", "dim", "v", "point", "n", F.coalesce("cell", F.lit(0)).alias("cell"), F.coalesce("home", F.lit(True)).alias("home"))
    placed = stored(placed, "cells")
    cell = ["label", "dim", "cell"]
    blocks = placed.groupBy(*cell).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = placed.join(blocks, cell).withColumn("own", F.pmod(F.xxhash64("point"), "blocks").cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    home = dealt.filter("home").select(*cell, F.col("own").alias("left"), each.alias("right"), "v", "point", "n")
    other = dealt.select(*_fresh(*cell), each.alias("left"), F.col("own").alias("right"), *_fresh("v", "point", "n"))
    pair = [*cell, "left", "right"]

    def meet(residents: pd.DataFrame, all_: pd.DataFrame) -> pd.DataFrame:
        if not len(residents) or not len(all_):
            return pd.DataFrame({"point": [], "links": [], "root": []})
        close = _unit(residents["v"]) @ _unit(all_["v"]).T >= threshold
        mine, theirs, n = residents["point"].to_numpy(), all_["point"].to_numpy(), all_["n"].to_numpy()
        close &= mine[:, None] != theirs[None, :]
        links = close @ n.astype(np.float64)
        rows, cols = np.nonzero(close)
        names, index = np.unique(np.concatenate([mine, theirs]), return_inverse=True)
        root = np.arange(len(names))
        a, b = index[: len(mine)][rows], index[len(mine) :][cols]
        while True:
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        touched = np.unique(np.concatenate([a, b]))
        out = pd.DataFrame({"point": names[touched], "links": 0, "root": names[root[touched]]})
        return pd.concat([out, pd.DataFrame({"point": mine, "links": links.astype(np.int64), "root": mine})[links > 0]])

    met = stored(home.groupBy(*pair).cogroup(other.groupBy(*pair)).applyInPandas(meet, "point long, links long, root long"), "links")
    counts = met.groupBy("point").agg(F.sum("links").alias("links"))
    groups = components(met.select(F.col("point").alias("a"), F.col("root").alias("b")))
    facts = points.drop("v").join(counts, "point", "left").join(groups.withColumnRenamed("node", "point"), "point", "left").select(
        "point", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "point").alias("component_id"))
    # points know their vectors' rows by vector; the row count of a very common vector is split by adaptive execution
    member = rows.filter("usable").select("id", "label", "v").join(
        points.select("label", "v", "point"), ["label", "v"]).select("id", "point").join(facts, "point").select("id", "n_links", "component_id")
    alone = rows.filter("NOT usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return member.unionByName(alone).select(
        F.col("id").alias(id_column), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


def _fresh(*names: str) -> list[Column]:
    """The columns under identities of their own, so that one table can stand on both sides."""
    return [F.col(n).alias(n) for n in names]


def _pivots(points: DataFrame, large: DataFrame, most: int) -> DataFrame:
    """``label, dim, number, v``: of each large label the points whose hashes fall in a share of the range that gives about
    one per block; numbered, and no more than ``most``. A label that happens to get none is one cell."""
    share = 2 * F.least(F.col("chunks"), F.lit(most)) / F.col("points")
    drawn = points.join(large, ["label", "dim"]).filter((F.xxhash64(F.lit("pivot"), "point").cast("double") / 2.0**64 + 0.5) < share)
    order = Window.partitionBy("label", "dim").orderBy(F.xxhash64(F.lit("pivot"), "point"), "point")
    return drawn.withColumn("number", F.row_number().over(order)).filter(
        F.col("number") <= F.least(F.col("chunks"), F.lit(most))).select("label", "dim", "number", "v")
