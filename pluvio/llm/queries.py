"""Registered queries of the numbered operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm import (collocations, embedding_dedup, exact_dedup, license_scan, lm_scoring, minhash_dedup,
                        packing, prefix_trie, quality_rules, sentencepiece_codec, substring_dedup, token_files, toxicity)
from pluvio.llm.shipping import shipped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.vector_links(table(spark, sf_dir, "embeddings"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digest(table(spark, sf_dir, "documents"),
                                         public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = substring_dedup.repeated_spans(table(spark, sf_dir, "documents"))
    return spans.select("doc_id", "n_words", "n_removed",
                        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(table(spark, sf_dir, "documents"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.minhash_groups(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.codec_digest(table(spark, sf_dir, "documents"),
                                            public_tokenizers.path("piece_bpe_32k.model"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("word_bpe_49k.json"), end_id=1, keep_ids=False)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {name: shipped(query) for name, query in {
    "op1_quality_rules": op1_quality_rules,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_token_files": op4_token_files,
    "op5_toxicity": op5_toxicity,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_minhash_dedup": op8_minhash_dedup,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_packing": op10_packing,
    "op11_collocations": op11_collocations,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}.items()}

ORACLE: dict[str, str] = {
    "op1_quality_rules": quality_rules.oracle_sql(),
    "op11_collocations": collocations.oracle_sql(),
    "op12_exact_dedup": exact_dedup.oracle_sql(),
    "op13_prefix_trie": prefix_trie.oracle_sql(),
}
