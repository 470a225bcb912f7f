"""Cleaning of ``documents`` for training: stages whose results are written as Parquet and read by the next.

Quality classifier (rejected documents go), near-duplicates (one of each group stays), benchmark decontamination (spans are
cut out, mostly copied documents go), personal data (masked), byte-level BPE. Every stage but the last returns the columns
of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm import decontamination, near_dedup, pii, quality
from loomwork.llm.queries import n_ids, quality_labels, round_trip, table
from loomwork.staging import staged

#: The stages change rows by trained models and cut spans out of texts, which SQL cannot express.
ORACLE_SQL = None


def measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now; documents without a text keep theirs."""
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, quality_labels(spark, sf_dir))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicated(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return measured(decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return measured(pii.masked(docs))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and what they decode to."""
    return round_trip(docs).select("doc_id", n_ids("ids").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("bpe_encoding", bpe_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
