"""One query for each operator, over its whole table; digests and counts are derived from the operators' results here."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.llm import oracle
from codequarry.llm.bpe import bpe_decode, bpe_encode
from codequarry.llm.embedding_dedup import embedding_links
from codequarry.llm.line_dedup import drop_repeated_lines
from codequarry.llm.mixing import mix
from codequarry.llm.quality import Band, with_quality
from codequarry.llm.rank_bpe import rank_decode, rank_encode
from codequarry.llm.repair import read_token_files, write_token_files
from codequarry.llm.resampling import resample
from codequarry.llm.secret_scan import secret_spans
from codequarry.llm.shared import work_folder
from codequarry.llm.sharding import shards
from codequarry.llm.simhash import simhash_groups
from codequarry.llm.url_filters import url_verdicts
from codequarry.llm.vector_codes import books_digest, vector_codes

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
SHARD_BYTES = 16 << 20
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: English by its own vocabulary, other languages by the one made for many.
VOCABULARIES = {"en": "byte_bpe_50k.tiktoken", None: "byte_bpe_multi_50k.tiktoken"}
#: Characters, and letters and digits, per token of a usual text (medians at sf0.1), and the share of broken characters allowed.
USUAL = {"en": (2.66, 2.15, 0.10), "de": (2.70, 2.22, 0.15), "fr": (2.42, 1.96, 0.15), "es": (2.44, 1.98, 0.15)}
#: One rule for all of them: at least 0.80 of the usual characters and 0.72 of the usual letters and digits per token.
BANDS = {k: Band(0.80 * chars, 8.0, broken, min_letters=0.72 * letters) for k, (chars, letters, broken) in USUAL.items()} | {
    None: Band(0.5, 10.0, 0.60)}
#: Null and other languages by script, between random letters and a hand-written text of it under the vocabulary for many;
#: "" (any other script, of which that vocabulary knows no words): only that it is no noise of symbols.
SCRIPT_BANDS = {
    "Latin": Band(1.8, 8.0, 0.15, min_letters=1.5), "Cyrillic": Band(1.7, 8.0, 0.15, min_letters=1.6),
    "Greek": Band(1.45, 6.0, 0.20, min_letters=1.25), "Han": Band(0.6, 4.0, 0.75, min_letters=0.52),
    "Kana": Band(0.75, 5.0, 0.40, min_letters=0.65), "Hangul": Band(0.9, 6.0, 0.45, min_letters=0.85),
    "Arabic": Band(1.5, 6.0, 0.15, min_letters=1.3), "Hebrew": Band(1.5, 6.0, 0.18, min_letters=1.28),
    "Devanagari": Band(0.78, 5.0, 0.65, min_letters=0.63), "Thai": Band(0.8, 5.0, 0.35, min_letters=0.8),
    "": Band(0.3, 4.0, 1.0, min_letters=0.25),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabularies() -> dict[str | None, str]:
    return {k: public_tokenizers.path(f) for k, f in VOCABULARIES.items()}


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_verdicts(table(spark, sf_dir, "pages"), rules)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(table(spark, sf_dir, "embeddings"), 0.93)


def bpe_digests(encoded: DataFrame, vocabulary: str) -> DataFrame:
    numbers = F.col("ids").cast("array<string>")
    return bpe_decode(encoded, vocabulary).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", numbers), 256).alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    return bpe_digests(bpe_encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path), path)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = with_quality(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), vocabularies(), BANDS, scripts=SCRIPT_BANDS)
    # the struct also holds the text, which is not looked at again
    return judged.select("doc.doc_id", "quality.*")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc.doc_id", "n_lines", "n_removed", F.col("clean").alias("text"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = secret_spans(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return spans.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(span_list(F.filter("spans", lambda s: s["rank"] < 3)), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"))


def op10_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path(VOCABULARY))
    tokens = read_token_files(spark, path, packed=True)
    return tokens.select("doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    encoded = rank_encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return rank_decode(encoded, path).select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes(table(spark, sf_dir, "embeddings"))
    return codes.withColumn("codebooks_sha256", F.lit(books_digest(books)))


QUERIES = {f.__name__: f for f in (
    op1_url_filters, op2_sharding, op3_embedding_near_dedup, op4_bpe, op5_quality_rules, op6_line_dedup, op7_mixing, op8_simhash,
    op9_secret_scan, op10_token_packing, op11_importance_resampling, op12_byte_bpe, op13_vector_codes)}
CHECKS = oracle.checks(URL_RULES, SHARD_BYTES)
