"""What the operators of this package share: the cluster's folder, stored tables, words and column names."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OWN: dict[str, str] = {}
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Makes this package importable in Python workers on all nodes, once for each application, as ``--py-files`` would."""
    # a row is a text here, so batches of 10,000 rows would be tens of megabytes in each worker
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="run-")) / "codequarry_llm_files.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in [root / "codequarry" / "__init__.py", *sorted(Path(__file__).parent.glob("*.py"))]:
            z.write(p, p.relative_to(root))
    context.addPyFile(str(archive))


def work_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, as in local tests, a folder of this application."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = tempfile.mkdtemp(prefix="run-")
        context.setCheckpointDir(_OWN[context.applicationId])
    return _OWN[context.applicationId]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read back: lineage ends here and survives lost executors."""
    path = f"{work_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of a small table (fixed row width); Spark removes it when nothing refers to it any more."""
    work_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def broadcast_if_small(df: DataFrame, rows: int, most: int = 100_000) -> DataFrame:
    """Asks for a broadcast of ``df`` if its counted ``rows`` of fixed width are few; else leaves the join to shuffles."""
    return F.broadcast(df) if rows <= most else df
