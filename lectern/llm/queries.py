"""The registered queries of this folder: each operator over whole tables, in its contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import (
    bpe,
    compression,
    exact_dedup,
    langid,
    licenses,
    line_dedup,
    packing,
    quality,
    secrets,
    sharding,
    simhash,
    suffix_dedup,
    whitening,
)
from lectern.llm.common import documents_of, embeddings_of
from lectern.llm.oracles import oracles

SHARDS = 40


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents_of(spark, sf_dir))


def exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents_of(spark, sf_dir))


def licensed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(documents_of(spark, sf_dir))


def secret(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(documents_of(spark, sf_dir))


def sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    metadata = documents_of(spark, sf_dir).select(
        "doc_id", "lang", "source", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = sharding.hilbert_shards(metadata, ["lang", "source"], ["size"], ["doc_id", "text_crc32"], SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(documents_of(spark, sf_dir))


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = quality.quality_verdicts(documents_of(spark, sf_dir))
    return found.select("doc_id", *[F.col(f"counts.{name}") for name in names], "base_failed", "kept")


def suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents_of(spark, sf_dir))


def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents_of(spark, sf_dir))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents_of(spark, sf_dir))


def compressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, codebooks = compression.compress(embeddings_of(spark, sf_dir))
    digits = F.transform("code", lambda index: F.lpad(F.lower(F.hex(index)), 2, "0"))
    return compression.with_label_error(codes).select(
        F.col("id").alias("vec_id"),
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(compression.codebooks_digest(codebooks)).alias("codebooks_sha256"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.without_repeated_lines(documents_of(spark, sf_dir))
    return found.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(embeddings_of(spark, sf_dir)).withColumnRenamed("id", "vec_id")
    # Beyond a long, the contract's type has no value; the operator's column has.
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


QUERIES = {
    "op1_packing": packed,
    "op2_exact_dedup": exact,
    "op3_licenses": licensed,
    "op4_secrets": secret,
    "op5_hilbert_shards": sharded,
    "op6_language_id": language,
    "op7_quality": judged,
    "op8_suffix_dedup": suffixes,
    "op9_simhash": near,
    "op10_bpe": encoded,
    "op11_vector_codes": compressed,
    "op12_line_dedup": lines,
    "op13_whitening": whitened,
}

ORACLES = oracles(SHARDS)
