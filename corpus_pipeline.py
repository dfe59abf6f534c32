"""From raw documents to packed training sequences, as stages that are written and read again.

Quality rules drop documents, near-duplicates leave one document of each group,
repeated passages leave the texts, sources are mixed to equal shares, and what
results is packed into sequences.  Every stage works on all rows that the one
before it kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialwright.llm import mixing, packing, quality, repeats, similar_texts
from dialwright.session import shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and read like those labelled good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.trusted_ids(labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share at least 0.8 of their five-word shingles: the one with the smallest id."""
    return similar_texts.one_of_each(docs, similarity=0.8, shingle_words=5)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what an earlier document already says in 50 equal bytes."""
    return repeats.without_repeats(docs, size=50).withColumn("n_chars", F.length("text").cast("long"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many documents as before, with equal expected shares of all sources, in random order."""
    return mixing.mix(docs, weights=None).drop("copy", "shuffle_key")


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with the sequence and offset each one got."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(docs, path, capacity=2048, end_id=0).drop("row_no")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixed_sources", mixed_sources),
    ("packed_sequences", packed_sequences),
]
#: SQL cannot express fingerprints by bit majority, sorted suffixes or packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written as Parquet and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
