"""The documents table from raw text to packed batches: each stage works on what the one before it
kept, is written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents, extra ones included. No stage changes a text, so null texts stay null; an empty table
gives an empty result. Repeated rows are judged alike; of rows with one doc_id, and of near
duplicates, which have no order but their ids, one stays, the others go; rows without an id all stay.
Texts of any length are looked at whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from satmart.llm import dart_minhash, gam, length_buckets, qgram_lemma, quality_rules, queries
from satmart.llm.common import table
from satmart.sources.storage import Stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what the additive model, learned from the quality labels, predicts to be bad."""
    return gam.keep_good(docs, queries.quality_model(spark, sf_dir))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what the base rules or the full policy of the rule ledger reject."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each class of near duplicates."""
    return dart_minhash.keep_one(docs, Stage(spark))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a passage of a benchmark item."""
    return qgram_lemma.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document kept, by its words."""
    return length_buckets.packed(docs, length_buckets.word_tokens(), Stage(spark))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Boosted trees, signatures and dynamic programming have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Stage(spark)
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
