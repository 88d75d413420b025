"""Repeated runs of lines, found by winnowing over line hashes; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codequarry.llm.shared import WORD, broadcast_if_small, checkpointed, stored, word_count


def _lines(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """``id, th, i, h, g, w, before``: each line with a word; ``th`` tells texts of one id apart, ``before`` counts words above."""
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    slim = docs.select(F.col(f"`{id_column}`").alias("id"), F.xxhash64(value).alias("th"), F.transform(
        F.split(value, "\n", -1), lambda x, i: F.struct(i.alias("i"), F.xxhash64(x).alias("h"), F.xxhash64(F.lit(1), x).alias("g"), word_count(x).alias("w"))
    ).alias("lines"))
    # equal rows are one document
    once = slim.groupBy("id", "th").agg(F.first("lines").alias("lines"))
    rows = once.select("id", "th", F.explode(F.filter("lines", lambda x: x["w"] > 0)).alias("x")).select("id", "th", "x.*")
    above = Window.partitionBy("id", "th").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("before", F.coalesce(F.sum("w").over(above), F.lit(0)))


def _windows(lines: DataFrame, min_words: int) -> DataFrame:
    """``id, th, first, last, h, g, at, c1, c2``: the shortest runs of ``min_words`` words that begin or end at a line; their
    minimum (``h, g`` at line ``at``, the last of equal ones) and a 128-bit hash of their content."""
    down = Window.partitionBy("id", "th").orderBy("before").rangeBetween(0, min_words - 1)
    after = F.col("before") + F.col("w")
    up = Window.partitionBy("id", "th").orderBy("after").rangeBetween(1 - min_words, 0)
    lines = lines.withColumn("after", after)

    def kind(frame) -> Column:
        least = F.min(F.struct("h", "g", (-F.col("i")).alias("at"))).over(frame)
        return F.struct(F.min("i").over(frame).alias("first"), F.max("i").over(frame).alias("last"), F.sum("w").over(frame).alias("words"),
                        least.alias("least"), F.xxhash64(F.collect_list("h").over(frame)).alias("c1"), F.xxhash64(F.collect_list("g").over(frame)).alias("c2"))

    both = lines.select("id", "th", kind(down).alias("down"), kind(up).alias("up"))
    each = both.select("id", "th", F.explode(F.when(F.col("down") == F.col("up"), F.array("down")).otherwise(F.array("down", "up"))).alias("x"))
    return each.filter(F.col("x.words") >= min_words).select(
        "id", "th", "x.first", "x.last", "x.least.h", "x.least.g", (-F.col("x.least.at")).alias("at"), "x.c1", "x.c2")


def repeated_lines(docs: DataFrame, min_words: int = 50, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, th, gone``: for each document with repeated lines, the numbers from 0 in order of all lines from the first to the last of
    each run, also those without words that stand between (``th``: hash of the document's text).

    A line is repeated if it lies in a run of lines of ``min_words`` words or more that equals a run at an earlier place:
    in a document with a smaller id, or further up in the same one. Lines without words neither count nor break a run.

    1. Every shortest window of ``min_words`` words selects its smallest line hash. A shared run contains such a window, so it
       has a selected fingerprint in both places, whatever stands around it.
    2. Fingerprints are counted by value; only those selected at two places or more can be part of a repeated run.
    3. From such a position the match is extended both ways over the windows that selected it: those that reach down from
       each line and those that reach up from each. A window's content is compared with its first occurrence by an
       aggregate, so a passage that all documents share costs a row for each, never a pair.
    4. Windows that are not the first of their content are repeated; together they are exactly the repeated runs.

    A line of many documents is one key of aggregates, which combine before the shuffle, and the many side of joins that
    adaptive execution splits. Windows over a document spill; other columns are not read.
    """
    windows = stored(_windows(_lines(docs, id_column, text), min_words), "windows")
    places = windows.select("id", "th", "at", "h", "g").distinct()
    shared = places.groupBy("h", "g").agg(F.count("*").alias("n")).filter("n > 1").select("h", "g")
    extended = windows.join(shared, ["h", "g"], "left_semi").select("id", "th", "first", "last", "c1", "c2")
    origin = extended.groupBy("c1", "c2").agg(
        F.min(F.struct("id", "th", "first")).alias("origin"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = extended.join(origin, ["c1", "c2"]).filter(~F.struct("id", "th", "first").eqNullSafe(F.col("origin")))
    # windows of a document that touch are many; keep for each first line the furthest last one before their lines are listed
    spans = later.groupBy("id", "th", "first").agg(F.max("last").alias("last"))
    order = Window.partitionBy("id", "th").orderBy("first")
    reach = F.coalesce(F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    fresh = spans.select("id", "th", F.greatest("first", reach + 1).alias("first"), "last").filter("first <= last")
    return fresh.groupBy("id", "th").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans")).select(
        "id", "th", F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["last"]))).alias("gone"))


def drop_repeated_lines(docs: DataFrame, min_words: int = 50, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc`` (a struct of all columns of ``docs``), ``n_lines``, ``n_removed`` and ``clean`` (the text without
    :func:`repeated_lines`) of each row; the first occurrence of a run stays.

    A null text has no lines and stays null; an empty one has one line. A document all of whose lines are repeated becomes
    the empty text. Rows equal in id and text are one document: each is returned, with the same lines removed. A null id
    stands before all others. Lines without words always stay. No documents: no rows.
    """
    gone = checkpointed(repeated_lines(docs, min_words, id_column, text))
    width = gone.agg(F.count("*"), F.coalesce(F.sum(F.size("gone")), F.lit(0))).first()
    # true where a line goes; nothing stands after the last such line
    flags = F.flatten(F.transform("gone", lambda x, k: F.concat(
        F.array_repeat(F.lit(False), x - F.coalesce(F.get("gone", k - 1), F.lit(-1)) - 1), F.array(F.lit(True)))))
    marked = gone.select(F.col("id").alias("gone_id"), F.col("th").alias("gone_th"), flags.alias("flags"))
    value = F.col(f"`{text}`")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{id_column}`").alias("id"), value.alias("text"),
                       F.xxhash64(F.coalesce(value, F.lit(""))).alias("th"))
    joined = rows.join(broadcast_if_small(marked, sum(width), 400_000), F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("th") == F.col("gone_th")), "left")
    stays = F.filter(F.split("text", "\n", -1), lambda x, i: ~(F.coalesce(F.get("flags", i), F.lit(False)) & x.rlike(WORD)))
    n_lines = F.coalesce(F.length("text") - F.length(F.translate("text", "\n", "")) + 1, F.lit(0)).cast("long")
    judged = joined.select("doc", "text", n_lines.alias("n_lines"), F.when(F.col("flags").isNotNull(), stays).alias("stays"))
    return judged.select(
        "doc", "n_lines", F.when(F.col("stays").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("stays")).cast("long").alias("n_removed"),
        F.when(F.col("stays").isNull(), F.col("text")).otherwise(F.array_join("stays", "\n")).alias("clean"))
