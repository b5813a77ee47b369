"""From raw documents to packed training sequences: each stage takes what its predecessor kept.

Toxic documents go, then depleted, short and repetitive ones (lines that recur across a host's documents are cut
from the rest), then all but one document of each group of near-duplicates; what is left is packed into
sequences. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seawarden.llm import near_dedup, packing, quality_rules, toxicity
from seawarden.llm.queries import labels, tokenizer_path
from seawarden.session import shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on labelled ones among them, does not reject."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels(spark, sf_dir)))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without lines that recur across their host's documents."""
    return quality_rules.clean(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return near_dedup.dedup(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("near-dedup", drop_near_copies),
    ("packing", pack),
]
#: Learnt scores, signatures and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    work = shared_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{work}/{number}")
        docs = spark.read.parquet(f"{work}/{number}")
    return docs
