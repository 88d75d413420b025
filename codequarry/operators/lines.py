"""Line table and text cuts.

Cuts happen late: only surviving rows meet the text again. Short cuts go through fixed-size text chunks, so
that neither a huge file nor a far offset in it makes a cut slow.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codequarry.functions.text import LINE_BREAK, signature_text, split_lines

# Fixed values that interactive callers ask for: lines in a body, context lines on either side.
BODY_LINES = 5000
CONTEXT_LINES = 200

_LINE_BITS = 6                 # a block of lines: 64
_LINES = 1 << _LINE_BITS
_CHUNK_BITS = 12
_CHUNK = 1 << _CHUNK_BITS      # characters per text chunk
_OVERLAP = 256                 # characters of the next chunk repeated at the end of a chunk


def source_lines(sources: DataFrame) -> DataFrame:
    """``file_id, line_no (1-based), text``."""
    return sources.select("file_id", F.posexplode(split_lines(F.col("code"))).alias("pos", "text")).select(
        "file_id", (F.col("pos") + 1).alias("line_no"), "text"
    )


def line_blocks(sources: DataFrame, shape: Callable[[Column], Column] | None = None) -> DataFrame:
    """``_file, _block, _lines``: the lines of each file in blocks of 64, each line shaped by ``shape``."""
    lines = split_lines(F.col("code"))
    held = sources.select("file_id", (lines if shape is None else F.transform(lines, shape)).alias("_all"))
    blocks = F.transform(
        F.sequence(F.lit(0), F.shiftright(F.size("_all") - 1, _LINE_BITS)),
        lambda i: F.slice("_all", i * _LINES + 1, _LINES))
    return held.filter("_all IS NOT NULL").select(F.col("file_id").alias("_file"), F.posexplode(blocks).alias("_block", "_lines"))


def line_at(
    rows: DataFrame, sources: DataFrame, row: str, out: str = "text", shape: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Add ``out`` = the line at 0-based ``row``; a missing line is the empty string.

    Keyed by (file, block of lines), so the lines of one big file are spread out and no line is a row of its own. ``shape`` is
    applied to each line before the join: a very long line that many rows ask for is then cut once, and never carried along.
    """
    on = (F.col("file_id") == F.col("_file")) & (F.shiftright(row, _LINE_BITS) == F.col("_block"))
    text = F.get("_lines", F.pmod(F.col(row), F.lit(_LINES)).cast("int"))
    return rows.join(line_blocks(sources, shape), on, "left").select(*rows.columns, F.coalesce(text, F.lit("")).alias(out))


def line_slice(
    rows: DataFrame, sources: DataFrame, first: Column, last: Column, cap: int | None = None,
    out: str = "text", flag: str = "truncated",
) -> DataFrame:
    """Add lines ``first..last`` (1-based, inclusive, clamped to the file; null: from the first, to the last line), all or at most
    ``cap``, and a flag.

    Each span is cut once, however many rows ask for it, and meets only the blocks that hold its lines. A span's own text is the
    largest thing put together.
    """
    open_end = F.lit((1 << 31) - 1)
    asked = rows.withColumns({
        "_first": F.greatest(first, F.lit(1)).cast("bigint"), "_last": F.coalesce(last, open_end).cast("bigint")})
    counts = sources.filter("code IS NOT NULL").select(
        F.col("file_id").alias("_file"), (F.regexp_count("code", F.lit(LINE_BREAK)) + 1).alias("_count"))
    spans = (
        asked.select(F.col("file_id").alias("_of"), F.col("_first").alias("_from"), F.col("_last").alias("_to")).distinct()
        .join(counts, F.col("_of") == F.col("_file")).drop("_file")
        .withColumn("_want", F.least("_to", "_count") - F.col("_from") + 1).filter("_want > 0")
    )
    end = F.col("_from") - 1 + (F.col("_want") if cap is None else F.least(F.col("_want"), F.lit(cap)))
    covered = F.sequence(F.shiftright(F.col("_from") - 1, _LINE_BITS), F.shiftright(F.greatest("_end", "_from") - 1, _LINE_BITS))
    parts = spans.withColumn("_end", end).withColumn("_at", F.explode(covered))
    begin = F.greatest(F.col("_from") - F.col("_at") * _LINES, F.lit(1))
    stop = F.least(F.col("_end") - F.col("_at") * _LINES, F.lit(_LINES))
    piece = F.array_join(F.slice("_lines", begin.cast("int"), (stop - begin + 1).cast("int")), "\n")
    texts = (
        parts.join(line_blocks(sources), (F.col("_of") == F.col("_file")) & (F.col("_at") == F.col("_block")))
        .groupBy("_of", "_from", "_to", "_want")
        .agg(F.array_join(F.sort_array(F.collect_list(F.struct("_at", piece.alias("text"))))["text"], "\n").alias("_text"))
    )
    on = (F.col("file_id") == F.col("_of")) & (F.col("_first") == F.col("_from")) & (F.col("_last") == F.col("_to"))
    cut = F.lit(False) if cap is None else F.coalesce(F.col("_want") > cap, F.lit(False))
    return asked.join(texts, on, "left").select(*rows.columns, F.coalesce("_text", F.lit("")).alias(out), cut.alias(flag))


def signature(defs: DataFrame, sources: DataFrame) -> DataFrame:
    """Add ``signature``: the line that holds the name, trimmed and clipped."""
    return line_at(defs, sources, "name_row", "signature", signature_text)


def clamp_context(lines: int | None) -> int:
    """Context lines asked for; none if absent or negative."""
    return max(0, lines or 0)


def with_body(defs: DataFrame, sources: DataFrame, before: int = 0, after: int = 0, cap: int | None = None) -> DataFrame:
    """Add ``body`` (widened by the context; whole unless ``cap`` lines bound it) and ``body_truncated``, which is true or null."""
    first = F.col("start_line") - clamp_context(before)
    last = F.col("end_line") + clamp_context(after)
    cut = line_slice(defs, sources, first, last, cap, out="body", flag="_cut")
    return cut.withColumn("body_truncated", F.when(F.col("_cut"), F.lit(True))).drop("_cut")


def with_context(defs: DataFrame, sources: DataFrame, before: int = 0, after: int = 0, cap: int | None = None) -> DataFrame:
    """Add ``context``, whole unless ``cap`` lines bound it, and ``context_truncated``, true or null; null when no context lines are asked for."""
    before, after = clamp_context(before), clamp_context(after)
    if not before and not after:
        return defs.withColumns({"context": F.lit(None).cast("string"), "context_truncated": F.lit(None).cast("boolean")})
    first, last = F.col("start_line") - before, F.col("end_line") + after
    cut = line_slice(defs, sources, first, last, cap, out="context", flag="_cut")
    return cut.withColumn("context_truncated", F.when(F.col("_cut"), F.lit(True))).drop("_cut")


def _chunks(sources: DataFrame) -> DataFrame:
    pieces = F.regexp_extract_all(F.col("code"), F.lit(r"(?s).{1,%d}" % _CHUNK), 0)
    return (
        sources.select("file_id", pieces.alias("_pieces"))
        .select(
            F.col("file_id").alias("_file"),
            F.posexplode(
                F.transform(
                    "_pieces",
                    lambda piece, i: F.concat(
                        piece, F.coalesce(F.substring(F.get("_pieces", i + 1), 1, _OVERLAP), F.lit(""))
                    ),
                )
            ).alias("_chunk", "_piece"),
        )
    )


def cut_clipped(
    rows: DataFrame, sources: DataFrame, start: str, end: str, cap: int, out: str, cut_rows: Column | None = None
) -> DataFrame:
    """Add ``out`` = at most ``cap`` (<= 256) characters of the span ``[start, end)``.

    Rows outside ``cut_rows`` keep the value they already have in ``out``, if any.
    """
    if cap > _OVERLAP:
        raise ValueError(f"cap must be at most {_OVERLAP}")
    place = F.col(start) % _CHUNK + 1
    length = F.least(F.col(end) - F.col(start), F.lit(cap))
    text = F.coalesce(F.substring(F.col("_piece"), place.cast("int"), length.cast("int")), F.lit(""))
    on = (F.col("file_id") == F.col("_file")) & (F.shiftright(start, _CHUNK_BITS) == F.col("_chunk"))
    kept = [c for c in rows.columns if c != out]
    if cut_rows is not None:
        text = F.when(F.coalesce(cut_rows, F.lit(False)), text)
        if out in rows.columns:
            text = F.coalesce(text, F.col(out))
    return rows.join(_chunks(sources), on, "left").select(*kept, text.alias(out))


def cut_whole(rows: DataFrame, sources: DataFrame, start: str, end: str, out: str) -> DataFrame:
    """Fill null ``out`` with the whole span, however long. Rows must be distinct.

    Rows that have their text already, the bulk, meet no join. The others are cut chunk by chunk and put
    together again.
    """
    todo = F.col(out).isNull() & F.col(start).isNotNull()
    done = rows.filter(~todo)
    columns = [c for c in rows.columns if c != out]
    last = F.greatest(F.col(end) - 1, F.col(start))
    covered = F.sequence(F.shiftright(start, _CHUNK_BITS), F.shiftright(last, _CHUNK_BITS))
    parts = rows.filter(todo).drop(out).withColumn("_at", F.explode(covered))
    begin = F.greatest(F.col(start), F.col("_at") * _CHUNK)
    stop = F.least(F.col(end), (F.col("_at") + 1) * _CHUNK)
    piece = F.substring(F.col("_piece"), (begin % _CHUNK + 1).cast("int"), (stop - begin).cast("int"))
    on = (F.col("file_id") == F.col("_file")) & (F.col("_at") == F.col("_chunk"))
    cut = (
        parts.join(_chunks(sources), on, "left")
        .groupBy(*columns)
        .agg(F.array_join(F.sort_array(F.collect_list(F.struct("_at", piece.alias("text"))))["text"], "").alias(out))
    )
    return done.unionByName(cut)
