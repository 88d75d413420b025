"""Secrets in texts: stated patterns, and strings whose sliding-window entropy is high; DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Kinds in the order they are listed in, their patterns, and (kept) characters at least. The last are candidates for entropy.
KINDS = [("assign", ASSIGN), ("access", r"AKIA[A-Z0-9]+"), ("hex", r"(?<![0-9a-f])[0-9a-f]{32,}"),
         ("entropy", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")]
LEAST = {"assign": 8, "access": 16, "hex": 32}
#: Characters of the sliding window, and bits of entropy that some window must reach, by class of characters: what 98 of 100
#: random strings of the class reach in one window. Letters without digits must reach more, as words run together come close.
WINDOW = 20
CLASSES = [("hex", [r"^[0-9A-Fa-f]+$", r"[0-9]", r"[A-Fa-f]"], 2.9), ("mixed", [r"[0-9]", r"[a-z]", r"[A-Z]"], 3.6),
           ("plain", [r"[0-9]", r"[A-Za-z]"], 3.3), ("letters", [r"[A-Za-z]"], 3.6)]
#: A word of under 20 letters, words in camel case, or a number. Repeats are possessive: they give nothing back, which changes
#: no match (parts and separators share no character), and a pattern of any length is matched without recursion.
_WORD = r"(?:[A-Z]{0,4}[a-z]{1,19}(?:[A-Z][a-z]{1,19})*+|[A-Z]{1,19}|[0-9]+)"
_NAME = r"(?:[A-Za-z]{1,19}[0-9]{0,4}|[0-9]+)"
#: Never secrets, however mixed: paths and words joined by dashes or underscores (with short numbers behind them), UUIDs,
#: alphabets, and what calls itself an example.
ALLOWED = [r"(?i)example|sample|placeholder|your[-_]", r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
           r"(?i)abcdefghij|0123456789", rf"^/?{_WORD}(?:[/_=-]++{_WORD})*+[/]?$", rf"^/?{_NAME}(?:[/_=-]++{_NAME})++[/]?$"]
SCALE = 1_000_000


def cost(n: int) -> int:
    """``n log2 n`` in millionths, so that sums are whole numbers and agree everywhere."""
    return round(n * math.log2(n) * SCALE) if n > 1 else 0


def most_cost(bits: float, window: int = WINDOW) -> int:
    """The sum of costs up to which a window's entropy, ``log2(window) - sum / window``, reaches ``bits``."""
    return math.floor((math.log2(window) - bits) * window * SCALE)


#: The lowest code of a key character; counts of ``PER`` codes lie side by side in a long, ``WIDE`` bits each.
FIRST, CODES, PER, WIDE = ord("+"), ord("z") - ord("+") + 1, 12, 5


def lowest_cost(text: Column, window: int = WINDOW) -> Column:
    """Of a string of key characters: the lowest sum of costs over all windows, by counts that are carried along. A step takes
    one character in and lets one go; only these two counts change, and the sum by what they add and lose."""
    if window >= 1 << WIDE:
        raise ValueError(f"windows have under {1 << WIDE} characters")
    costs = F.array(*[F.lit(cost(n)).cast("long") for n in range(window + 2)])
    change = lambda new, old: F.get(costs, new) - F.get(costs, old)
    size = F.length(text)
    codes = F.transform(F.split(text, ""), lambda c: F.ascii(c) - FIRST)
    # what comes and what goes, side by side, so that a step looks nothing up in the text
    moves = F.arrays_zip(F.slice(codes, F.lit(window + 1), size).alias("new"), F.slice(codes, F.lit(1), F.greatest(size - window, F.lit(0))).alias("old"))
    place = lambda code: F.floor(code / PER).cast("int")
    shift = lambda code: (WIDE * (code % PER)).cast("int")
    one = lambda code, i: F.when(place(code) == i, F.call_function("shiftleft", F.lit(1).cast("long"), shift(code))).otherwise(F.lit(0).cast("long"))
    held = lambda counts, code: F.call_function("shiftright", F.get(counts, place(code)), shift(code)).bitwiseAND((1 << WIDE) - 1).cast("int")

    def full(state: Column, move: Column) -> Column:
        new, old = move["new"], move["old"]
        gone = held(state["counts"], old)
        before = held(state["counts"], new) - F.when(new == old, 1).otherwise(0)
        total = state["sum"] + change(gone - 1, gone) + change(before + 1, before)
        counts = F.transform(state["counts"], lambda x, i: x + one(new, i) - one(old, i))
        return F.struct(counts.alias("counts"), total.alias("sum"), F.least(state["low"], total).alias("low"))

    def filling(state: Column, new: Column) -> Column:
        before = held(state["counts"], new)
        counts = F.transform(state["counts"], lambda x, i: x + one(new, i))
        total = state["sum"] + change(before + 1, before)
        return F.struct(counts.alias("counts"), total.alias("sum"), total.alias("low"))

    empty = F.struct(F.array(*[F.lit(0).cast("long")] * -(-CODES // PER)).alias("counts"), F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("low"))
    begun = F.aggregate(F.slice(codes, 1, window), empty, filling)
    return F.aggregate(moves, begun, full, lambda s: s["low"])


def secret_spans(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and ``spans``, an array of ``start, rank, kind, end`` sorted by start, then kind.

    Patterns are searched leftmost and without overlap, each kind by itself; matches that are too short are dropped. What
    no pattern covers is a candidate if it is a long run of key characters: it is a secret if one of its windows reaches the entropy
    of its class (hex, mixed case with digits, other letters with digits, letters) and no allow-list pattern holds. Such spans are of kind
    ``entropy``; one that overlaps a pattern's span is left out. Positions count code points, the end exclusive.

    Matches are listed with the gap before each; positions are running sums, so a long text is as many rows as it has
    matches. The text is not shuffled, only matches are; no document is joined with another, so hot groups do no harm.
    Null is the empty text and has no spans; repeated rows, null ids and ties each give their row. Other columns are not read.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_column}`").alias("id"), value.alias("text"))
    found = []
    for rank, (name, pattern) in enumerate(KINDS):
        zipped = F.arrays_zip(F.transform(F.split("text", pattern, -1), lambda x: F.length(x)).alias("gap"),
                              F.regexp_extract_all("text", F.lit(pattern), 0).alias("match"))
        listed = F.transform(zipped, lambda x, i: F.struct(F.lit(rank).alias("rank"), i.alias("n"), x["gap"].alias("gap"), x["match"].alias("match")))
        found.append(F.when(F.col("text").rlike(pattern), listed).otherwise(F.array().cast("array<struct<rank:int,n:int,gap:int,match:string>>")))
    rows = base.select("row", "id", F.explode_outer(F.concat(*found)).alias("x")).select("row", "id", "x.*").repartition("row")
    order = Window.partitionBy("row", "rank").orderBy("n")
    size = F.coalesce(F.length("match"), F.lit(0))
    upto = F.sum(F.col("gap") + size).over(order).cast("long")
    placed = rows.select("row", "id", "rank", "match", (upto - size).alias("start"), upto.alias("end")).filter("rank IS NULL OR match IS NOT NULL")
    limit = F.lit(None).cast("long")
    for _, patterns, bits in reversed(CLASSES):
        member = F.lit(True)
        for pattern in patterns:
            member = member & F.col("match").rlike(pattern)
        limit = F.when(member, F.lit(most_cost(bits))).otherwise(limit)
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | F.col("match").rlike(pattern)
    named = placed.withColumn("limit", F.when((F.col("rank") == 3) & ~allowed, limit))
    low = F.when(F.col("limit").isNotNull(), lowest_cost(F.col("match")))
    key = F.when(F.col("rank") == 0, F.length(F.regexp_extract("match", ASSIGN, 2))).otherwise(F.length("match"))
    least = F.when(F.col("rank") == 0, LEAST["assign"]).when(F.col("rank") == 1, LEAST["access"]).otherwise(LEAST["hex"])
    good = F.coalesce(F.when(F.col("rank") == 3, low <= F.col("limit")).otherwise(key >= least), F.lit(False))
    kind = F.element_at(F.array(*[F.lit(k) for k, _ in KINDS]), F.col("rank") + 1)
    # an entropy span that meets a pattern's span: the furthest end before it, or a start inside it
    span = F.when(good, F.struct("start", "rank", kind.alias("kind"), "end"))
    marked = named.select("row", "id", span.alias("span"))
    here = Window.partitionBy("row").orderBy(F.col("span.start"))
    solid = F.col("span.rank") < 3
    ended = F.max(F.when(solid, F.col("span.end"))).over(here.rangeBetween(Window.unboundedPreceding, 0))
    ahead = F.min(F.when(solid, F.col("span.start"))).over(here.rangeBetween(0, Window.unboundedFollowing))
    clear = solid | (F.coalesce(ended <= F.col("span.start"), F.lit(True)) & F.coalesce(ahead >= F.col("span.end"), F.lit(True)))
    kept = marked.select("row", "id", F.when(clear, F.col("span")).alias("span"))
    return kept.groupBy("row").agg(F.first("id").alias("id"), F.sort_array(F.collect_list("span")).alias("spans")).select(F.col("id").alias(id_column), "spans")
