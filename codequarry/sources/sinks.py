"""Writing results: plain tables, node tables laid out for the joins here, and JSON reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, format: str = "parquet", by: list[str] | None = None) -> None:
    """Write a result; ``by`` gives partition columns of few values, such as ``language``."""
    writer = df.write.mode("overwrite").format(format)
    (writer.partitionBy(*by) if by else writer).save(path)


def write_nodes(nodes: DataFrame, path: str) -> None:
    """Store a node table by language, sorted by type inside its files.

    Language filters then skip folders and type filters skip row groups. Rows are spread by file and node
    block, so a huge file is split over many output files.
    """
    spread = nodes.repartition("language", "file_id", F.floor(F.col("pre") / (1 << 20)))
    spread.sortWithinPartitions("language", "type").write.mode("overwrite").partitionBy("language").parquet(path)


def report_json(df: DataFrame, out: str = "report") -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct("*")).alias(out))
