"""From raw documents to token ids: quality rules, line deduplication, near-duplicate removal, mixing, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.llm.bpe import bpe_encode
from codequarry.llm.line_dedup import drop_repeated_lines
from codequarry.llm.mixing import mix
from codequarry.llm.quality import with_quality
from codequarry.llm.queries import BANDS, SCRIPT_BANDS, VOCABULARY, bpe_digests, vocabularies
from codequarry.llm.shared import stored
from codequarry.llm.simhash import one_of_each


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return with_quality(docs, vocabularies(), BANDS, scripts=SCRIPT_BANDS).filter("quality.kept").select("doc.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that stand earlier; ``n_chars`` follows the text. None is dropped here."""
    cleaned = drop_repeated_lines(docs)
    new = {"text": F.col("clean"), "n_chars": F.coalesce(F.length("clean"), F.lit(0)).cast("long")}
    return cleaned.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mix(docs).filter("copies > 0")
    return mixed.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document under the vocabulary, as count and digests, with the digest of what they decode to."""
    path = public_tokenizers.path(VOCABULARY)
    return bpe_digests(bpe_encode(docs.select("doc_id", "text"), path), path)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("SimHash near-dedup", simhash_dedup),
          ("source mix", source_mix), ("BPE", bpe)]
#: SQL cannot express tokenizers, XXH64 or the fitting of the mix; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
