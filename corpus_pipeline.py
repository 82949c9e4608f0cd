"""Corpus cleaning pipeline: ordered stages over the documents table.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows it gets. All
but the last return the columns of their input; the last returns the pieces of
the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pluvio.llm import minhash_dedup, packing, quality_rules, substring_dedup, toxicity
from pluvio.llm.queries import table
from pluvio.llm.shipping import shipped
from pluvio.session import scratch_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects. Null and empty texts have no words and
    are rejected; very long texts are judged whole; repeated rows and null ids are
    judged each; extra columns pass through; an empty table stays empty."""
    return quality_rules.accepted(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under one half; a score of exactly one half goes.
    Null and empty texts are scored like texts without words; very long texts are
    scored whole; repeated rows and null ids are scored each; extra columns pass
    through; an empty table stays empty."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id. Null and
    empty texts are linked with nothing and stay, as rows without an id do; very
    long texts are compared on their full sets; extra columns pass through; an empty
    table stays empty. Five-word shingles at 80 %; the four words of op8 belong to that
    query."""
    return minhash_dedup.first_of_groups(docs, shingle=5, percent=80)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that repeat in the corpus. Rows are never dropped; null,
    empty and short texts are unchanged; repeated rows count as copies of each other;
    ids are not used; extra columns pass through; an empty table stays empty."""
    return substring_dedup.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed into sequences of 2048 tokens. Null and empty texts
    are the end token only; very long texts are cut into pieces; repeated rows and
    null ids are documents each; extra columns are left out; an empty table has no
    pieces."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, keep_ids=False)


STAGES = [(name, shipped(stage)) for name, stage in (
    ("quality_rules", keep_quality),
    ("toxicity", drop_toxic),
    ("minhash_dedup", keep_first_copies),
    ("substring_dedup", drop_passages),
    ("packing", pack),
)]

#: Tokenization and learned scores are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet to the
    shared folder and reread as the next stage's input."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
