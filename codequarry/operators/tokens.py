"""Tokens and bracket pairs from raw text.

A file is one row of text (at most 10 MiB after admission), so windows over one file's tokens are bounded.
Files are distributed while they are still compact text; the windows then reuse that distribution, and
no exploded token is ever shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codequarry.functions.layout import once_and_again, spread_files
from codequarry.functions.lexicon import HTML_COMMENT, HTML_RAW, HTML_TILE, LEXICONS, by_language

_OPEN, _CLOSE = "([{", ")]}"
BRACKETS = _OPEN + _CLOSE


def tokens(sources: DataFrame, apart: str | None = None, blanks: bool = True) -> DataFrame:
    """``file_id, language, pos, kind, text, start_idx, end_idx, row, col`` for the lexed languages.

    Kinds: string, comment, word, space, other. Tokens tile the text. Rows and columns are 0-based.

    With ``apart`` (some of the characters that are no part of words or spaces, for callers that look at these alone) all that
    stands between strings, comments and these characters is one token of the kind run; the others are the same, but for ``pos``.
    Without ``blanks`` tokens of the kind space are left out, though ``pos`` counts them: each is read with the token before it and
    is no row of the windows.
    """
    if apart is not None and not blanks:
        raise ValueError("runs hold blanks")
    lexed = sources.filter(F.col("language").isin(list(LEXICONS)))
    lang = F.col("language")
    tile = by_language(
        lang, lambda x: x.runs(apart) if apart is not None else x.tile if blanks else x.tile_and_blanks, F.lit(""))
    text = F.col("text")
    first = F.substring(text, 1, 1)
    long = F.length(text) > 1
    hash_comments = [k for k, v in LEXICONS.items() if any(c.startswith("#") for c in v.comments)]
    kind = (
        F.when(long & first.isin('"', "'", "`"), "string")
        .when(long & (first == "/"), "comment")
        .when((first == "#") & lang.isin(hash_comments), "comment")
    )
    if apart is None:
        kind = (
            kind.when(first.rlike(r"[ \t\r\n\f]"), "space")
            .when(text.rlike(r"^[\p{L}\p{M}\p{N}_$]") & ((first != "$") | long), "word")
            .otherwise("other")
        )
    else:
        kind = kind.when(text.isin(list(apart)), "other").otherwise("run")
    if blanks:
        return tile_text(lexed, "code", tile, ["file_id", "language"]).withColumn("kind", kind)
    lexed, again = once_and_again(lexed.select("file_id", "language", "code"))
    # A comment up to the end of the line may itself end with blanks; all other tokens end with something else.
    to_line_end = F.startswith(text, F.lit("//")) | (F.startswith(text, F.lit("#")) & lang.isin(hash_comments))
    token = F.when(to_line_end, F.substring_index(text, "\n", 1)).otherwise(F.rtrim(text, F.lit(" \t\r\n\f")))
    held = F.when((token == "") | (F.length(token) == F.length(text)), 1).otherwise(2)
    cut = tile_text(lexed, "code", tile, ["file_id", "language"], held).withColumn("text", token).filter("text <> ''")
    cut = cut.withColumn("end_idx", F.col("start_idx") + F.length("text")).withColumn("kind", kind)
    return cut.unionByName(tokens(again).filter("kind <> 'space'"))


def tile_text(df: DataFrame, column: str, tile: Column | str, keep: list[str], held: Column | None = None) -> DataFrame:
    """Cut a text column into tiles with offsets and positions; keyed by ``file_id``.

    ``pos`` numbers the tiles, or what they hold if ``held`` says how many things a tile holds.
    """
    pattern = F.lit(tile) if isinstance(tile, str) else tile
    cut = spread_files(df).select(
        *keep, F.posexplode(F.regexp_extract_all(column, pattern, F.lit(0))).alias("pos", "text")
    )
    return placed(cut, held)


def placed(cut: DataFrame, held: Column | None = None) -> DataFrame:
    """Tiles ``text`` of files, in the order of ``pos``, with their offsets and positions."""
    before = Window.partitionBy("file_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    length = F.length("text")
    breaks = length - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    summed = cut.withColumns({
        "start_idx": F.coalesce(F.sum(length).over(before), F.lit(0)).cast("int"),
        "row": F.coalesce(F.sum(breaks).over(before), F.lit(0)).cast("int"),
        "held": F.lit(None) if held is None else F.coalesce(F.sum(held).over(before), F.lit(0)).cast("int"),
    })
    # Where the current line starts: one past the last line break seen so far.
    last_break = F.when(
        F.col("text").contains("\n"), F.col("start_idx") + length - F.length(F.substring_index("text", "\n", -1))
    )
    line_start = F.coalesce(F.max(last_break).over(before), F.lit(0))
    laid = summed.withColumns({
        "col": (F.col("start_idx") - line_start).cast("int"),
        "end_idx": F.col("start_idx") + length,
    })
    return (laid if held is None else laid.withColumn("pos", F.col("held"))).drop("held")


def bracket_pairs(toks: DataFrame) -> DataFrame:
    """Pairs of round, square and curly brackets."""
    sides = toks.filter((F.col("kind") == "other") & F.col("text").isin(list(_OPEN + _CLOSE)))
    opening = F.col("text").isin(list(_OPEN))
    kind = F.translate("text", _CLOSE, _OPEN)
    return match_pairs(sides.withColumns({"pair_kind": kind, "side": F.when(opening, 1).otherwise(-1)}))


def match_pairs(sides: DataFrame) -> DataFrame:
    """Pair opens (``side`` 1) with closes (-1): last opened, first closed, separately per ``pair_kind``.

    One row per open with its partner's place (null: never closed), one per stray close; ``status`` is
    paired, missing or error. ``depth`` counts the open ones of the same kind around it.
    """
    order = ["file_id", "pair_kind"]
    in_order = Window.partitionBy(*order).orderBy("pos")
    level = F.col("running") + F.when(F.col("side") == 1, 0).otherwise(1)
    # Every stray close lowers the level of what follows; the lowest sum so far says by how much.
    strays = F.least(F.min("running").over(in_order), F.lit(0))
    by_level = Window.partitionBy(*order, "level").orderBy("pos")
    partner = ("side", "pos", "start_idx", "end_idx", "row", "col")
    summed = sides.withColumn("running", F.sum("side").over(in_order))
    linked = summed.withColumns({"level": level, "strays": strays}).withColumns({
        "next": F.lead(F.struct(*partner)).over(by_level), "last_side": F.lag("side").over(by_level),
    })
    closed = F.col("next")["side"] == -1
    stray = (F.col("side") == -1) & ~F.coalesce(F.col("last_side") == 1, F.lit(False))
    is_open = F.col("side") == 1
    return linked.filter(is_open | stray).select(
        "file_id", "pair_kind", "pos", "start_idx", "row", "col", "text",
        F.when(is_open & closed, "paired").when(is_open, "missing").otherwise("error").alias("status"),
        *[F.when(is_open & closed, F.col("next")[c]).alias(f"close_{c}") for c in partner[1:]],
        F.greatest(F.col("level") - 1 - F.col("strays"), F.lit(0)).cast("int").alias("depth"),
    )


def page_tokens(pages: DataFrame) -> DataFrame:
    """Tokens of markup (``file_id, html``), with tag names; void and self-closing tags open nothing."""
    cut = tile_text(pages, "html", HTML_TILE, ["file_id"])
    text = F.col("text")
    tag = F.lower(F.regexp_extract(text, r"^</?([A-Za-z][^\s/>]*)", 1))
    kind = (
        F.when(~F.startswith(text, F.lit("<")) | (text == "<"), "text")
        .when(text.rlike("^" + HTML_COMMENT), "comment")
        .when(text.rlike(f"^(?:{HTML_RAW})"), F.concat(tag, F.lit("_element")))
        .when(F.startswith(text, F.lit("<!")), "doctype")
        .when(F.startswith(text, F.lit("</")), "close")
        .when(tag.isin(VOID_TAGS), "void")
        .when(F.endswith(text, F.lit("/>")), "self_closing")
        .otherwise("open")
    )
    return cut.withColumns({"tag": tag, "kind": kind})


def page_pairs(toks: DataFrame) -> DataFrame:
    """Pairs of opening and closing tags, per tag name."""
    sides = toks.filter(F.col("kind").isin("open", "close"))
    return match_pairs(
        sides.withColumns({"pair_kind": F.col("tag"), "side": F.when(F.col("kind") == "open", 1).otherwise(-1)})
    )


# Markup tags that never have content.
VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track",
             "wbr"]
