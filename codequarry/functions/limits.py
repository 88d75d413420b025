"""First-k per group without gathering a hot group on one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Up to this k Spark itself trims every group before the shuffle
# (spark.sql.optimizer.windowGroupLimitThreshold, default 1000).
_TRIMMED_BY_SPARK = 1000
_SALTS = 64


def first_k(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """Rows ranked 1..k inside their group, with the rank in column ``rank``."""
    if k > _TRIMMED_BY_SPARK:
        # A group is first cut to k rows per salt, so that the last step sees at most salts * k rows of it.
        salt = F.pmod(F.hash(*order_names(df, keys)), F.lit(_SALTS))
        df = df.withColumn("_salt", salt)
        salted = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = df.withColumn(rank, F.row_number().over(salted)).filter(F.col(rank) <= k).drop("_salt", rank)
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(
        F.col(rank) <= k
    )


def order_names(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """Columns a salt may be drawn from: all atomic ones outside the group key."""
    return [f.name for f in df.schema.fields if f.name not in keys and f.dataType.typeName() in
            ("integer", "long", "short", "string", "double", "boolean")]


def with_totals(df: DataFrame, counted: DataFrame, keys: Sequence[str], total: str) -> DataFrame:
    """Attach the uncapped row count of each group (partial counts are combined before the shuffle)."""
    return df.join(counted.groupBy(*keys).agg(F.count(F.lit(1)).alias(total)), list(keys), "left")
