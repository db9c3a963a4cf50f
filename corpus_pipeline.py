"""From raw documents to packed training sequences.

Five stages, each applied to everything the one before kept and written as Parquet in the
shared scratch folder, so a lost executor costs at most the running stage:

1. ``quality``: documents that the quality classifier rejects go.
2. ``line_dedup``: lines shared by many documents go, except in one of them.
3. ``near_dedup``: one document of each group of near copies (five-word shingles) stays.
4. ``decontamination``: documents that hold a benchmark item go.
5. ``packing``: the remaining documents become token pieces placed in sequences.

All stages but the last return the columns they were given. An empty table passes through
as an empty result; null texts count as empty; see the operators for the other edge cases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablelearn.llm import decontaminate, lines, neardup, packing, quality
from tablelearn.llm.common import table
from tablelearn.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.drop_low_quality(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: A classifier and a tokenizer are not SQL; the tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; the places of all token pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
