"""Connected components of a graph given as edges, by rounds of joins that halve the distance to the smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codequarry.llm.shared import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that each node of ``edges`` (``a``, ``b`` long) can reach.

    Alternates two steps until no edge changes: every node hands its larger neighbours, then its smaller ones, to the
    smallest of its neighbours. The edges only ever get shorter, and their number never grows. A hub is one key of an
    aggregate (combined before the shuffle) and the many side of a join that adaptive execution splits; neighbours are
    never gathered in a list. Nodes without an edge are not returned; self loops and repeated edges do no harm.
    """
    links = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    links = checkpointed(links)
    seen = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(lowest, "a")
        small = joined.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                              F.col("m").alias("b")).filter("a <> b").distinct()
        links = checkpointed(small)
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    return links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
