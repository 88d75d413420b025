"""Text expressions. All but :func:`to_nfc` are built-in SQL functions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# Text lengths of the result columns.
LEAF_CHARS = 80
CLIP_CHARS = 200

LINE_BREAK = r"\r?\n"
# What a browser-style trim removes: ASCII blanks, every Unicode separator, and the byte order mark.
_BLANK = r"[\s\p{Z}\x{FEFF}]"


def trim_ws(text: Column) -> Column:
    """Trim Unicode white space on both ends; the look-behind keeps long inner runs linear."""
    return F.regexp_replace(text, rf"^{_BLANK}++|(?<!{_BLANK}){_BLANK}++$", "")


def clip(text: Column, chars: int = CLIP_CHARS) -> Column:
    return F.substring(text, 1, chars)


def split_lines(code: Column) -> Column:
    """Lines of a text; a trailing line break yields a last empty line, a lone CR breaks nothing."""
    return F.split(code, LINE_BREAK, -1)


def signature_text(line: Column) -> Column:
    return clip(trim_ws(line))


def unquote(text: Column) -> Column:
    """Strip one leading and one trailing single or double quote, each on its own."""
    return F.regexp_replace(text, "^[\"']|[\"']\\z", "")


def is_ascii(text: Column) -> Column:
    return ~text.rlike(r"[^\x00-\x7F]")


def to_nfc(df: DataFrame, column: str, out: str) -> DataFrame:
    """Add ``out`` = NFC of ``column``. ASCII rows, the bulk, never leave the JVM."""

    # Defined here so that it is shipped by value: executors need not have this package installed.
    @pandas_udf(StringType())
    def nfc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda s: unicodedata.normalize("NFC", s), na_action="ignore")

    ascii_row = F.coalesce(is_ascii(F.col(column)), F.lit(True))
    return (
        df.filter(ascii_row)
        .withColumn(out, F.col(column))
        .unionByName(df.filter(~ascii_row).withColumn(out, nfc(F.col(column))))
    )
