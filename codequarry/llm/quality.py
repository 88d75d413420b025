"""Quality rules from how public vocabularies cut a text."""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry.llm.bpe import built, vocabulary
from codequarry.llm.chunks import SPLIT, ChunkEncoder, portions, slices


@dataclass(frozen=True)
class Band:
    """What a language's texts may look like: characters per token, share of tokens that are no whole characters, bits
    of token entropy, at least the smaller of ``min_entropy`` and ``min_evenness`` times the logarithm of the tokens, and
    letters and digits per token. The last sees symbols between words also where a vocabulary has tokens for such symbols."""

    min_chars: float
    max_chars: float
    max_fallback: float
    min_entropy: float = 3.5
    min_evenness: float = 0.5
    min_letters: float = 0.0


#: Scripts by the first word of their characters' Unicode names; any other script is "".
SCRIPTS = {"LATIN": "Latin", "CYRILLIC": "Cyrillic", "GREEK": "Greek", "CJK": "Han", "HIRAGANA": "Kana", "KATAKANA": "Kana",
           "HANGUL": "Hangul", "ARABIC": "Arabic", "HEBREW": "Hebrew", "DEVANAGARI": "Devanagari", "THAI": "Thai"}
MEASURES = T.StructType([
    *[T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("n_tokens", T.LongType()),
    *[T.StructField(n, T.DoubleType()) for n in ("chars_per_token", "fallback_share", "token_entropy")],
    T.StructField("kept", T.BooleanType()),
])
_SYMBOLS, _SPACES = [*b"#*$%&|<>"], [*range(0x09, 0x0E), 0x20]


def base_measures(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, and words in repeated windows of three words."""
    words = text.split()
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = int(counts.sum() - counts[0x80:0xC0].sum() - counts[_SPACES].sum())
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    repeated = 0
    if len(words) > 3:
        names: dict[bytes, int] = {}
        ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
        pairs = ids[:-1] * len(names) + ids[1:]
        if len(names) >= 1 << 20:
            pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        _, index, often = np.unique(pairs[:-1] * len(names) + ids[2:], return_inverse=True, return_counts=True)
        twice = often[index] > 1
        inside = np.zeros(len(words), bool)
        for k in range(3):
            inside[k : k + len(twice)] |= twice
        repeated = int(inside.sum())
    return len(words), chars, int(counts[_SYMBOLS].sum()), len(lines) - len(set(lines)), repeated


@cache
def _letters() -> tuple[list[str], np.ndarray]:
    """Names of scripts, and for every code point 0 (no letter, mark or digit), 1 (digit) or 2 and the place of its script."""
    names = ["", *dict.fromkeys(SCRIPTS.values())]
    kinds = np.zeros(0x110000, np.uint8)
    for point in range(len(kinds)):
        category = unicodedata.category(chr(point))[0]
        if category == "N":
            kinds[point] = 1
        elif category in "LM":
            kinds[point] = 2 + names.index(SCRIPTS.get(unicodedata.name(chr(point), "").split(" ")[0], ""))
    return names, kinds


def letters(text: str) -> tuple[int, str | None]:
    """Letters, marks and digits of a text, and the script of most of its letters (null: it has none)."""
    names, kinds = _letters()
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    counts = np.bincount(kinds[points], minlength=len(names) + 2)
    return int(counts[1:].sum()), names[int(counts[2:].argmax())] if counts[2:].any() else None


def _meter(content: str) -> tuple[ChunkEncoder, np.ndarray]:
    """The encoder of a rank file, and which ids are no whole characters by themselves."""
    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line)}
    encoding = tiktoken.Encoding("public", pat_str=SPLIT.pattern, mergeable_ranks=ranks, special_tokens={})
    partial = np.zeros(max(ranks.values()) + 1, bool)
    for token, rank in ranks.items():
        try:
            token.decode("utf-8")
        except UnicodeDecodeError:
            partial[rank] = True
    return ChunkEncoder(lambda chunks: [encoding.encode_ordinary(c) for c in chunks], {}), partial


def with_quality(docs: DataFrame, vocabularies: dict[str | None, str], bands: dict[str | None, Band], text: str = "text",
                 language: str = "lang", min_words: int = 50, max_repeated: float = 0.5, scripts: dict[str, Band] | None = None) -> DataFrame:
    """``doc`` (a struct of all columns of ``docs``) and ``quality`` (:data:`MEASURES`) for each row.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeated`` of them in repeated three-word windows.
    The text is then cut by the vocabulary (a path to a rank file) of its language, or that under None, and judged by its
    language's band, or that under None: characters per token, share of tokens that hold broken characters (fallback to
    bytes), entropy of its tokens, and letters and digits per token. ``kept`` is false if the base failed or any measure
    lies outside. With ``scripts``, a text of a null or unlisted language is judged by the band of the script that most of
    its letters are of, by that under "" for any other script, and not kept without letters.

    Everything is taken from whole texts and each row by itself: bands are stated, not fitted. A null or empty text has no
    words and fails; its measures are 0. A null or unknown language is cut by the vocabulary under None. Repeated rows each
    get their verdict, other columns pass through inside ``doc``, and an empty table stays empty.
    """
    spark = docs.sparkSession
    contents = {k: vocabulary(spark, p) for k, p in vocabularies.items()}
    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    places = docs.columns.index(text), docs.columns.index(language)
    schema = T.StructType([slim.schema["doc"], T.StructField("quality", MEASURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([pa.field(f.name, {T.LongType: pa.int64(), T.DoubleType: pa.float64(), T.BooleanType: pa.bool_()}[type(f.dataType)]) for f in MEASURES])
        other = scripts or bands[None]
        for batch in slices(batches):
            whole = batch.column(0)
            texts = [t or "" for t in whole.field(places[0]).to_pylist()]
            languages = [None if x is None else str(x) for x in whole.field(places[1]).to_pylist()]
            for first, last in portions(texts):
                rows = [None] * (last - first)
                by: dict[str | None, list[int]] = {}
                for i in range(first, last):
                    by.setdefault(languages[i] if languages[i] in contents else None, []).append(i)
                for name, at in by.items():
                    encoder, partial = built("quality", contents[name], _meter)
                    ids, counts = encoder.encode([texts[i] for i in at])
                    bounds = np.concatenate([[0], np.cumsum(counts)])
                    for k, i in enumerate(at):
                        rows[i - first] = _row(texts[i], ids[bounds[k] : bounds[k + 1]], partial, other if languages[i] is None else bands.get(languages[i], other), min_words, max_repeated)
                yield pa.RecordBatch.from_arrays([whole.slice(first, last - first), pa.array(rows, kind)], ["doc", "quality"])
        for content in contents.values():  # workers stay for later stages; what they remember of this one's texts need not
            built("quality", content, _meter)[0].done()

    return slim.mapInArrow(run, schema)


def _row(text: str, ids: np.ndarray, partial: np.ndarray, band: Band | dict[str, Band], min_words: int, max_repeated: float) -> dict:
    words, chars, symbols, lines, repeated = base_measures(text.encode("utf-8"))
    failed = words < min_words or repeated > max_repeated * words
    n = len(ids)
    often = np.unique(ids, return_counts=True)[1]
    entropy = float(np.log2(n) - (often * np.log2(often)).sum() / n) if n else 0.0
    per_token, fallback = (len(text) / n, float(partial[ids].sum()) / n) if n else (0.0, 0.0)
    n_letters, script = letters(text)
    if isinstance(band, dict):
        band = band.get(script, band[""]) if script is not None else None
    inside = n > 0 and band is not None and n_letters >= band.min_letters * n and (
        band.min_chars <= per_token <= band.max_chars and fallback <= band.max_fallback
        and entropy >= min(band.min_entropy, band.min_evenness * float(np.log2(n)))
    )
    return {
        "n_words": words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": lines, "n_repeat_words": repeated,
        "base_failed": failed, "n_tokens": n, "chars_per_token": per_token, "fallback_share": fallback,
        "token_entropy": max(0.0, entropy), "kept": bool(inside and not failed),
    }
