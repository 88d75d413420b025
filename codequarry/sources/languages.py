"""Language dimension: ids, file extensions, and which rule families each language has."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.sources.rules import RULES

# Language -> file extensions.
EXTENSIONS = {
    "python": ["py", "pyi"],
    "javascript": ["js", "mjs", "cjs", "jsx"],
    "typescript": ["ts", "mts", "cts"],
    "tsx": ["tsx"],
    "go": ["go"],
    "rust": ["rs"],
    "c": ["c", "h"],
    "cpp": ["cc", "cpp", "cxx", "hpp", "hxx", "hh"],
    "java": ["java"],
    "ruby": ["rb"],
    "bash": ["sh", "bash"],
    "json": ["json"],
    "yaml": ["yaml", "yml"],
    "html": ["html", "htm"],
    "css": ["css"],
    "php": ["php"],
}

LANGUAGES = list(EXTENSIONS)
LANGUAGE_OF = {ext: lang for lang, exts in EXTENSIONS.items() for ext in exts}


def resolve_language(name: str) -> str:
    """Language id for an id or an extension, in any case; ``ValueError`` if there is none."""
    key = name.lower()
    if key in LANGUAGE_OF:
        return LANGUAGE_OF[key]
    if key in EXTENSIONS:
        return key
    raise ValueError(f"unknown language: {name!r}")


def languages_with(family: str) -> list[str]:
    """Languages that have at least one rule of a family (definition, call, import)."""
    having = {r.lang for r in RULES if r.family == family}
    return [lang for lang in LANGUAGES if lang in having]


def languages_ext(spark: SparkSession) -> DataFrame:
    """Extension dimension, 31 rows."""
    return spark.createDataFrame(list(LANGUAGE_OF.items()), "ext string, language string")


def language_capabilities(spark: SparkSession) -> DataFrame:
    """One row per language: its extensions and which rule families it has."""
    families = {f: languages_with(f) for f in ("definition", "call", "import")}
    return (
        languages_ext(spark)
        .groupBy("language")
        .agg(F.sort_array(F.collect_list("ext")).alias("extensions"))
        .select(
            "language",
            F.col("language").isin(families["definition"]).alias("has_definition_rules"),
            F.col("language").isin(families["call"]).alias("has_call_rules"),
            F.col("language").isin(families["import"]).alias("has_import_rules"),
            "extensions",
        )
    )
