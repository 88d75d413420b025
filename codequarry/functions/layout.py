"""Data layout before a text is taken apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def spread_files(df: DataFrame) -> DataFrame:
    """Distribute whole files over ``spark.sql.shuffle.partitions`` tasks, while they are compact text.

    The number is given explicitly: without it, adaptive execution would merge partitions by the size of the
    compact text, and what follows makes many rows of it.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, "file_id")


def once_and_again(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files whose ``file_id`` comes once, and those that share it with others and are read together, token by token."""
    counted = df.withColumn("_copies", F.count(F.lit(1)).over(Window.partitionBy("file_id")))
    return counted.filter("_copies = 1").drop("_copies"), counted.filter("_copies > 1").drop("_copies")
