"""Tiling patterns: one regular expression per language that cuts any text into tokens without gaps.

Quantifiers are possessive, so that long strings and comments neither backtrack nor recurse.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_DOUBLE = r'"(?:[^"\\\n]++|\\[\s\S])*+"'
_SINGLE = r"'(?:[^'\\\n]++|\\[\s\S])*+'"
_DOUBLE_LONG = r'"(?:[^"\\]++|\\[\s\S])*+"'
_SINGLE_LONG = r"'(?:[^'\\]++|\\[\s\S])*+'"
_TICKS = r"`(?:[^`\\]++|\\[\s\S])*+`"
_TICKS_RAW = r"`[^`]*+`"
_CHAR = r"'(?:[^'\\\n]|\\[^'\n]++|\\')'"
_LINE = r"//[^\n]*+"
_HASH = r"#[^\n]*+"
_BLOCK = r"/\*[^*]*+\*++(?:[^/*][^*]*+\*++)*+/"
_STARTS = "\"'`/#"   # every string and comment begins with one of these
BLANK = r"[ \t\r\n\f]"
_TRIPLE = r'"""[\s\S]*?"""|' + r"'''[\s\S]*?'''"


@dataclass(frozen=True)
class Lexicon:
    strings: tuple[str, ...]
    comments: tuple[str, ...]
    word_extra: str = ""

    @property
    def string(self) -> str:
        return "|".join(self.strings) or r"[^\s\S]"

    @property
    def comment(self) -> str:
        return "|".join(self.comments) or r"[^\s\S]"

    @property
    def word_chars(self) -> str:
        return rf"\p{{L}}\p{{M}}\p{{N}}_{self.word_extra}"

    @property
    def word(self) -> str:
        return f"[{self.word_chars}]++"

    @property
    def tile(self) -> str:
        return f"{self.string}|{self.comment}|{self.word}|{BLANK}++|[\\s\\S]"

    @property
    def tile_and_blanks(self) -> str:
        """The same tiles, each with the blanks behind it."""
        return f"(?:{self.string}|{self.comment}|{self.word}|[^{BLANK[1:]}){BLANK}*+|{BLANK}++"

    def runs(self, apart: str = "") -> str:
        """The same strings and comments, and runs of all between them; characters of ``apart`` stand alone.

        Words and blanks hold none of the characters that begin a string or comment, so these are found in the same places.
        """
        return rf"{self.string}|{self.comment}|[^{_STARTS}{re.escape(apart)}]++|[\s\S]"

    @property
    def to_word(self) -> str:
        """In text whose strings and comments are blanked: what stands before the next word (group 1), and that word (2)."""
        return f"([^{self.word_chars}]*+)([{self.word_chars}]*+)"

    @property
    def to_call(self) -> str:
        """In such text: all up to the next word before an opening parenthesis (group 1), and that word (2); at last, the rest."""
        return rf"((?:[^{self.word_chars}]*+{self.word}(?!{BLANK}*+\())*+[^{self.word_chars}]*+)([{self.word_chars}]*+)"


_SCRIPT = Lexicon((_DOUBLE, _SINGLE, _TICKS), (_LINE, _BLOCK), "$")
LEXICONS = {
    "python": Lexicon((_TRIPLE, _DOUBLE, _SINGLE), (_HASH,)),
    "javascript": _SCRIPT,
    "typescript": _SCRIPT,
    "tsx": _SCRIPT,
    "go": Lexicon((_DOUBLE, _CHAR, _TICKS_RAW), (_LINE, _BLOCK)),
    "rust": Lexicon((_DOUBLE_LONG, _CHAR), (_LINE, _BLOCK)),
    "c": Lexicon((_DOUBLE, _SINGLE), (_LINE, _BLOCK)),
    "cpp": Lexicon((_DOUBLE, _SINGLE), (_LINE, _BLOCK)),
    "java": Lexicon((r'"""[\s\S]*?"""', _DOUBLE, _SINGLE), (_LINE, _BLOCK), "$"),
    "ruby": Lexicon((_DOUBLE_LONG, _SINGLE_LONG), (_HASH,)),
    "bash": Lexicon((_DOUBLE_LONG, r"'[^']*+'"), (_HASH,)),
    "php": Lexicon((_DOUBLE_LONG, _SINGLE_LONG), (_LINE, _BLOCK, _HASH)),
}

# Markup: comments, scripts and styles are single tokens; their content may look like tags.
HTML_COMMENT = r"<!--[\s\S]*?-->"
HTML_RAW = r"(?i:<script\b[^>]*+>[\s\S]*?</script\s*+>|<style\b[^>]*+>[\s\S]*?</style\s*+>)"
HTML_TAG = r"</?[A-Za-z][^<>]*+>"
HTML_DOCTYPE = r"<![^<>]*+>"
HTML_TILE = f"{HTML_COMMENT}|{HTML_RAW}|{HTML_TAG}|{HTML_DOCTYPE}|[^<]++|[\\s\\S]"


def by_language(column: Column, choose, otherwise: Column) -> Column:
    """``choose(lexicon)`` as a literal for each language of the column."""
    out = None
    for language, lexicon in LEXICONS.items():
        value = F.lit(choose(lexicon))
        out = F.when(column == language, value) if out is None else out.when(column == language, value)
    return out.otherwise(otherwise)


def plain_regex(pattern: str) -> str:
    """The pattern with ordinary quantifiers, for engines without possessive ones (same tiles)."""
    return pattern.replace("*+", "*").replace("++", "+")
