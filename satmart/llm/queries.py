"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satmart.llm import (
    chat_windows,
    common,
    dart_minhash,
    gam,
    host_reputation,
    length_buckets,
    nnpu,
    phrases,
    ppm,
    qgram_lemma,
    quality_rules,
    rans,
    spelling_variants,
    suffix_repeats,
)
from satmart.llm.common import table
from satmart.sources.storage import Stage

URL_RULES = host_reputation.rules_of(
    "allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/",
    "block com/de/",
)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule ledger of every document: measurements, failure bits, base and full policy."""
    book = quality_rules.ledger(table(spark, sf_dir, "documents"), ["doc_id"])
    base = quality_rules.rejected(quality_rules.BASE)
    return book.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"),
        (~base & ~quality_rules.rejected(quality_rules.FULL)).alias("kept"),
        "n_lines", "fail_bits",
    )


def op6_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats all conversations and one of control strings, and digests what is read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    both = F.array(F.lit("user"), F.lit("assistant"))
    control = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.posexplode(both).alias("turn", "role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    stage = Stage(spark)
    return chat_windows.read_back(stage(chat_windows.windows(turns.unionByName(control)), "chat"))


def op9_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page; a page's outcome is the quality label of the same id."""
    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select(
        F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return host_reputation.judge(
        table(spark, sf_dir, "pages").select("page_id", "url"), outcomes, URL_RULES, Stage(spark))


def op2_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word and byte-context scores of every document, learned from six sevenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = common.fold(F.col("doc_id"), 7) == 2
    return ppm.scored(docs, ~held_out, Stage(spark)).withColumn("held_out", held_out)


def op3_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document, by five-word shingles at 0.8."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dart_minhash.classes(docs, Stage(spark))


def op4_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document, or piece of a long one, by its words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return length_buckets.packed(docs, length_buckets.word_tokens(), Stage(spark))


def op5_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as coded segments and decoded from the files."""
    path = f"{Stage(spark).root}/segments"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rans.write(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return rans.read(spark, path)


def op7_qgram_lemma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of benchmark items: one row per document and item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = qgram_lemma.overlaps(docs, table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("row.doc_id", "found.*")


def op8_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from two thirds of the labels and unlabelled text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = common.fold(F.col("doc_id"), 3) == 1
    model = nnpu.train(docs, table(spark, sf_dir, "labels"), ~held_out, Stage(spark))
    rows = nnpu.scored(docs, model, ["doc_id"]).select("row.doc_id", "score", "predicted")
    return rows.withColumn("held_out", held_out)


def quality_model(spark: SparkSession, sf_dir: str) -> gam.Model:
    """Fitted to the quality labels of two thirds of the documents."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(common.fold(F.col("doc_id"), 3) != 1)
    return gam.train(docs, labels.select("doc_id", F.col("quality").alias("label")))


def op10_gam_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from two thirds of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = gam.scored(docs, quality_model(spark, sf_dir), ["doc_id"])
    held_out = common.fold(F.col("row.doc_id"), 3) == 1
    return rows.select("row.doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document less the bytes of passages of 200 bytes that occur again anywhere."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return suffix_repeats.without_repeats(docs, Stage(spark)).select(
        "doc_id", "n_bytes", removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first collocations of each language, by FM-indexes over shards of word ids."""
    docs = table(spark, sf_dir, "documents").select("text", "lang")
    return phrases.collocations(docs, Stage(spark))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its near words' number, its form and its root."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling_variants.grouped(docs, Stage(spark)).select(
        "word", "form", "root", "n", "n_near", "form_n")


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_ppm_scores": op2_ppm_scores,
    "op3_dart_minhash": op3_dart_minhash,
    "op4_length_buckets": op4_length_buckets,
    "op5_rans_tokens": op5_rans_tokens,
    "op6_chat_windows": op6_chat_windows,
    "op7_qgram_lemma": op7_qgram_lemma,
    "op8_nnpu_toxicity": op8_nnpu_toxicity,
    "op9_host_reputation": op9_host_reputation,
    "op10_gam_quality": op10_gam_quality,
    "op11_suffix_repeats": op11_suffix_repeats,
    "op12_phrase_index": op12_phrase_index,
    "op13_spelling_variants": op13_spelling_variants,
}
