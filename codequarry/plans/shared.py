"""Tables written once and read by many queries, in the folder the cluster shares."""

from __future__ import annotations

import hashlib
import re
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: dict[tuple, str] = {}
_LOCAL: dict[str, str] = {}
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def shared_folder(spark: SparkSession) -> str | None:
    """``spark.checkpoint.dir``; a temporary folder only where it is unset and Spark runs on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        return None
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="run-")
    return _LOCAL[context.applicationId]


def shared_table(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[SparkSession, str], DataFrame], buckets: int | None = None
) -> DataFrame:
    """``build(spark, sf_dir)``, written once per application; on a cluster without a folder it stays lazy.

    With ``buckets`` it is laid out by ``file_id``: tables with as many buckets meet on it, and on keys that begin with it,
    without being shuffled again (:func:`by_file`). Rows that come in as many partitions by ``file_id`` give one file each.
    """
    folder = shared_folder(spark)
    if folder is None:
        return build(spark, sf_dir)
    app = spark.sparkContext.applicationId
    key = (app, sf_dir, name)
    place = hashlib.md5(sf_dir.encode()).hexdigest()[:12]
    table = re.sub(r"\W", "_", f"codequarry_{app}_{place}_{name}")
    if key not in _WRITTEN:
        path = f"{folder.rstrip('/')}/codequarry-{app}/{place}/{name}"
        built = build(spark, sf_dir)
        if buckets is None:
            built.write.mode("overwrite").parquet(path)
        else:
            laid = built.write.mode("overwrite").bucketBy(buckets, "file_id").option("compression", "zstd")
            was = spark.conf.get(_WRITERS)
            # Rows of one bucket need no sort by bucket; a task that meets more than these sorts from there on.
            spark.conf.set(_WRITERS, "4")
            try:
                laid.option("path", path).saveAsTable(table, format="parquet")
            finally:
                spark.conf.set(_WRITERS, was)
        _WRITTEN[key] = path
    return spark.read.parquet(_WRITTEN[key]) if buckets is None else spark.table(table)


def by_file(spark: SparkSession) -> None:
    """Lets joins keyed by (file, node), (file, line) and so on use tables that lie by file as they lie.

    For tables whose files are bounded, as those of the corpus: one huge file would be one task.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    # A bucket is a task also where no join needs it, so that what is written from it is one bucket again.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
