"""One scan: from a table of files to definitions, errors and totals, all about the same selected files."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codequarry.operators import report
from codequarry.operators.definitions import definitions
from codequarry.operators.lexical import lexical_definitions
from codequarry.sources.files import (
    MAX_BYTES, NUL_PROBE_BYTES, cap_files, decode_text, detect_language, exclude_paths, include_paths, scan_status,
)

Keep = Callable[[str, DataFrame], DataFrame]


@dataclass(frozen=True)
class Scan:
    """What a scan found. All tables are lazy, and read the same stored files if the scan was given a ``keep``."""

    matched: DataFrame       # file_id, path, language, scanned, error: selected files; skipped ones are neither scanned nor in error
    sources: DataFrame       # file_id, path, language, code of the scanned files
    definitions: DataFrame   # definitions of the scanned files

    @property
    def scanned(self) -> DataFrame:
        return self.matched.filter("scanned").select("file_id", "path", "language")

    def errors(self, cap: int | None = None) -> DataFrame:
        """``path, stage, error`` of refused files."""
        refused = self.matched.filter(F.col("error").isNotNull()).select("path", F.lit("admit").alias("stage"), "error")
        return report.scan_errors(refused, cap)

    def summary(self, reported: int = report.REPORTED_FILES, listed_errors: int = report.LISTED_ERRORS) -> DataFrame:
        """One row of totals over exactly the files this scan selected."""
        return report.scan_summary(self.matched, self.definitions, self.errors(), reported, listed_errors)

    def file_totals(self) -> DataFrame:
        """Every selected file with its state and its number of definitions; none for files that were not scanned."""
        counts = self.definitions.groupBy("file_id").agg(F.count(F.lit(1)).alias("total"))
        return self.matched.join(counts, "file_id", "left").withColumn(
            "total", F.when(F.col("scanned"), F.coalesce("total", F.lit(0))))

    def by_language(self) -> DataFrame:
        return report.by_language(self.scanned, self.definitions)

    def by_kind(self) -> DataFrame:
        return report.by_kind(self.definitions)

    def reports(self, max_files: int | None = None, limit_per_file: int | None = None, signatures: bool = True) -> DataFrame:
        """Scanned files with their totals and definitions in order."""
        return report.file_reports(self.scanned, self.definitions, self.sources, max_files, limit_per_file, signatures)


def scan(
    files: DataFrame, patterns: Sequence[str] = (), language: str | None = None, exclude: Sequence[str] = (),
    max_files: int | None = None, max_bytes: int | None = MAX_BYTES, nul_probe: int | None = NUL_PROBE_BYTES,
    nodes: DataFrame | None = None, keep: Keep | None = None,
) -> Scan:
    """Select, judge, decode and extract: ``files (path, content)``, optionally with ``file_id`` and ``length``.

    Without ``file_id`` the path is the key. Paths with a null are not selected; null content is an error row. With ``nodes``
    definitions come from the node table, read for scanned files only; otherwise from the text itself, approximately.
    ``keep(name, df)`` may store a table in a folder that all executors share and give it back read from there: bytes are
    then read, judged and decoded once, whatever is asked of the result, and a lost executor costs no second scan.
    """
    keep = keep or (lambda name, df: df)
    keyed = files if "file_id" in files.columns else files.withColumn("file_id", F.col("path"))
    wanted = [c for c in ("file_id", "path", "content", "length") if c in keyed.columns]
    selected = cap_files(exclude_paths(include_paths(keyed.select(*wanted), patterns, language), exclude), max_files)
    judged = decode_text(detect_language(scan_status(selected, language, max_bytes=max_bytes, nul_probe=nul_probe)))
    table = keep("scan_files", judged.select(
        "file_id", "path", "language", "scanned", "error", F.when(F.col("scanned"), F.col("code")).alias("code")))
    sources = table.filter("scanned").select("file_id", "path", "language", "code")
    if nodes is not None:
        found = definitions(nodes.join(sources.select("file_id"), "file_id", "left_semi"), sources)
    else:
        # text has no nodes: the place of the name orders what starts on one line
        found = lexical_definitions(sources).withColumns({
            "seen_pre": F.col("name_row"), "seen_name": F.col("name_col"), "seen_pattern": F.lit(0)})
    return Scan(table.drop("code"), sources, keep("scan_definitions", found))
