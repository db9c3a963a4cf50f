"""The registered queries of this subpackage: thin applications of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelearn.llm import conversation, decontaminate, fingerprints, langid, lines, mixing, neardup, packing, quality, rollups, spans, toxicity, vectorcodes
from tablelearn.llm.common import table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted-sampling fingerprints of every text and of its edited text."""
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify_languages(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lose sentences to spans repeated in earlier documents or places."""
    out = spans.remove_repeated(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "first_doc_ids", "n_sentences", "n_removed", "n_words_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents over 2-word shingles."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of 2048."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts and the hash of the kept text of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs))
    return out.select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"),
        F.sha2("__kept", 256).alias("kept_sha256"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals by source, language and tokenizer version after insert, revision and deletion batches."""
    return rollups.corpus_rollup(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, one row per pair."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.classify_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources by target weights takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings in four codebooks, with their squared errors."""
    return vectorcodes.compress(table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after damage."""
    return conversation.repair_damaged(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_language_id": op2_language_id,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_line_dedup": op6_line_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_decontamination": op8_decontamination,
    "op9_quality": op9_quality,
    "op10_toxicity": op10_toxicity,
    "op11_source_mixing": op11_source_mixing,
    "op12_vector_codes": op12_vector_codes,
    "op13_conversation_repair": op13_conversation_repair,
}
