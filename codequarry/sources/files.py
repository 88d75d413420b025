"""Source files: loading, selection by path, admission, decoding, language detection."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.sources.languages import EXTENSIONS, LANGUAGE_OF, languages_ext, languages_with, resolve_language

# Folders and file names left out by default.
EXCLUDED_FOLDERS = ["node_modules", "dist", "build", ".git", "target", "venv", ".venv", "__pycache__", "coverage",
                    ".next", ".nuxt", "out"]
EXCLUDED_NAMES = ["*.min.js", "*.min.css", "*.map"]
# Size limit and NUL probe that decide admission unless a caller says otherwise; files of an interactive report.
MAX_BYTES = 10 * 1024 * 1024
NUL_PROBE_BYTES = 8192
MAX_FILES = 500


def load_sources(df: DataFrame) -> DataFrame:
    """Any table with ``file_id`` and ``code`` as a sources table; absent columns become null."""
    have = set(df.columns)
    return df.select(
        "file_id",
        *[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in ("path", "language")],
        F.col("code"),
    )


def load_source_tree(spark: SparkSession, root: str) -> DataFrame:
    """``path`` (relative to the root), ``length`` and ``content`` of every regular file below a folder.

    The reader leaves out names starting with an underscore or a dot and empty files; use
    :mod:`codequarry.sources.tree` where those matter.
    """
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return read.select(relative_path(F.col("path"), root).alias("path"), "length", "content")


def relative_path(path: Column, root: str) -> Column:
    plain = re.sub(r"^[a-z][a-z0-9+.-]*:/*", "/", root).rstrip("/")
    bare = F.regexp_replace(path, "^[a-zA-Z][a-zA-Z0-9+.-]*:/*", "/")
    return F.when(F.startswith(bare, F.lit(plain + "/")), F.substring(bare, len(plain) + 2, 1 << 30)).otherwise(bare)


def check_globs(patterns: Sequence[str] = (), excludes: Sequence[str] = ()) -> None:
    """Refuse parent steps, absolute patterns and negated excludes."""
    for glob in (*patterns, *excludes):
        if ".." in glob:
            raise ValueError(f"glob must not contain '..': {glob}")
    for glob in patterns:
        if glob.startswith(("/", "\\")):
            raise ValueError(f"pattern must be relative: {glob}")
    for glob in excludes:
        if glob.startswith("!"):
            raise ValueError(f"negated exclude not allowed: {glob}")


def glob_regex(glob: str) -> str:
    """A glob (``**``, ``*``, ``?``, ``[..]``, ``{a,b}``) as an anchored regular expression on relative paths."""
    tokens = re.findall(r"/\*\*$|\*\*/|\*\*|\*|\?|\[!?[^\]]+\]|[{},]|\\.|.", glob, flags=re.S)
    depth, out = 0, []
    for t in tokens:
        if t == "{":
            depth += 1
            out.append("(?:")
        elif t == "}" and depth:
            depth -= 1
            out.append(")")
        elif t == "," and depth:
            out.append("|")
        elif t[0] == "[" and len(t) > 1:
            out.append("[^/" + t[2:] if t[1] in "!^" else t)
        else:
            out.append({"/**": "/.+", "**/": "(?:.*/)?", "**": ".*", "*": "[^/]*", "?": "[^/]"}.get(t)
                       or re.escape(t[-1]))
    return "^(?s:" + "".join(out) + ")$"


def include_paths(df: DataFrame, patterns: Sequence[str] = (), language: str | None = None) -> DataFrame:
    """Keep files by pattern; without patterns, by the language's extensions, else by all known ones.

    Extensions are compared as written (lower case), and names starting with a dot are left out.
    """
    check_globs(patterns)
    if patterns:
        fits = [F.col("path").rlike(glob_regex(p)) & ~_hidden(p) for p in patterns]
        return df.filter(reduce(Column.__or__, fits))
    df = df.filter(~_hidden(""))
    extensions = EXTENSIONS[resolve_language(language)] if language else list(LANGUAGE_OF)
    name = F.substring_index("path", "/", -1)
    return df.filter(name.contains(".") & F.substring_index(name, ".", -1).isin(extensions))


def _hidden(pattern: str) -> Column:
    """A dot name in the path, unless this pattern spells out a dot segment; others open nothing for it."""
    if re.search(r"(^|/)\.", pattern):
        return F.lit(False)
    return F.col("path").rlike(r"(^|/)\.")


def exclude_paths(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Drop default folders and names, and what the user's globs match. Paths are relative to the root."""
    check_globs(excludes=extra)
    folders = F.slice(F.split("path", "/"), 1, F.size(F.split("path", "/")) - 1)
    in_folder = F.arrays_overlap(folders, F.array(*[F.lit(f) for f in EXCLUDED_FOLDERS]))
    globs = [f"**/{n}" for n in EXCLUDED_NAMES] + list(extra)
    return df.filter(~in_folder & ~F.col("path").rlike("|".join(glob_regex(g) for g in globs)))


def cap_files(df: DataFrame, max_files: int | None = None) -> DataFrame:
    """The whole corpus, or for an interactive report the first ``max_files`` by path."""
    return df if max_files is None else df.orderBy("path").limit(max_files)


def extension(path: Column) -> Column:
    """Lower-cased extension; empty for names without one and for names like ``.profile``."""
    name = F.substring_index(path, "/", -1)
    return F.lower(F.regexp_extract(name, r"^.+\.([^.]*)$", 1))


def detect_language(df: DataFrame, explicit: str = "explicit_language") -> DataFrame:
    """Add ``language`` (null if unknown) and ``language_error``. An explicit id or alias wins over the path."""
    given = F.lower(explicit) if explicit in df.columns else F.lit(None).cast("string")
    dim = F.broadcast(languages_ext(df.sparkSession).select("ext", F.col("language").alias("_lang")))
    keyed = df.withColumn("_given", F.when(given != "", given)).withColumn(
        "_key", F.coalesce("_given", extension(F.col("path")))
    )
    joined = keyed.join(dim, F.col("_key") == F.col("ext"), "left")
    is_id = F.col("_given").isin(list(EXTENSIONS))
    language = F.coalesce("_lang", F.when(is_id, F.col("_given")))
    failure = F.when(F.col("_given").isNotNull(), F.concat(F.lit("unknown language: "), F.col("_given"))).when(
        F.col("path").isNull(), "no language and no path"
    ).otherwise(F.concat(F.lit("no language for extension: "), F.col("_key")))
    return joined.select(*[c for c in df.columns if c != "language"], language.alias("language"),
                         F.when(language.isNull(), failure).alias("language_error"))


def _kept_extensions(language: str | None) -> list[str]:
    allowed = languages_with("definition")
    if language is not None:
        allowed = [lang for lang in allowed if lang == resolve_language(language)]
    return [e for lang in allowed for e in EXTENSIONS[lang]]


def language_filter(df: DataFrame, language: str | None = None) -> DataFrame:
    """Keep files whose extension has definition rules (and is the asked language); the rest go silently."""
    return df.filter(extension(F.col("path")).isin(_kept_extensions(language)))


def _refusal(df: DataFrame, content: str, max_bytes: int | None, nul_probe: int | None) -> Column:
    """Why a file is refused, or null. Judges bytes, or ``length`` and ``has_nul`` where there are none.

    ``max_bytes=None`` admits files of any size, ``nul_probe=None`` looks for a NUL in the whole file.
    """
    if content in df.columns:
        length = F.coalesce(F.col("length"), F.octet_length(content)) if "length" in df.columns \
            else F.octet_length(content)
        nul = F.position(F.unhex(F.lit("00")), F.substring(content, 1, nul_probe or (1 << 31) - 1)) > 0
        unread = F.col(content).isNull()
    else:
        length, nul, unread = F.col("length"), F.col("has_nul"), F.lit(False)
    return (
        F.when(length > max_bytes if max_bytes is not None else F.lit(False), F.concat(F.lit("file too large: "), length.cast("string")))
        .when(unread, "read failed")
        .when(F.coalesce(nul, F.lit(False)), "binary file: NUL byte")
    )


def admit(df: DataFrame, content: str = "content", max_bytes: int | None = MAX_BYTES,
          nul_probe: int | None = NUL_PROBE_BYTES) -> tuple[DataFrame, DataFrame]:
    """Split files into admitted ones and error rows ``(path, stage, error)``."""
    judged = df.withColumn("_error", _refusal(df, content, max_bytes, nul_probe))
    ok = judged.filter(F.col("_error").isNull()).drop("_error")
    errors = judged.filter(F.col("_error").isNotNull()).select(
        "path", F.lit("admit").alias("stage"), F.col("_error").alias("error")
    )
    return ok, errors


def scan_status(df: DataFrame, language: str | None = None, content: str = "content", max_bytes: int | None = MAX_BYTES,
                nul_probe: int | None = NUL_PROBE_BYTES) -> DataFrame:
    """Matched files with ``scanned`` and ``error``, in one pass: skipped files have neither."""
    skipped = ~extension(F.col("path")).isin(_kept_extensions(language))
    error = F.when(~skipped, _refusal(df, content, max_bytes, nul_probe))
    return df.withColumns({"error": error, "scanned": ~skipped & error.isNull()})


def decode_text(df: DataFrame, content: str = "content", out: str = "code") -> DataFrame:
    """Bytes to text: bad UTF-8 becomes U+FFFD, one leading byte order mark is dropped."""
    text = F.make_valid_utf8(F.col(content).cast("string"))
    return df.withColumn(out, F.regexp_replace(text, r"\A\x{FEFF}", ""))
