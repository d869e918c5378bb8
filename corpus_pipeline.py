"""Corpus pipeline: documents -> filtered, deduplicated, mixed and encoded.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one before
it kept.  All but the last return the columns of ``documents``; the last returns the
distinct sampled segmentations of each document (and copy of it in the mix), a row for
each, with their token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mediafeat.llm import jaccard_join, mixing, piece_sampling, suffix_dedup, toxicity
from mediafeat.llm.common import scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents scored toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of documents linked at a 5-word Jaccard of 0.8, the first stays."""
    return jaccard_join.one_of_each(docs, 5, 80, 100)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: strings of 100 bytes that start earlier are cut from the text."""
    return suffix_dedup.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: sources in their target shares, documents repeated or left out."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: segmentations of each text, sampled without replacement."""
    return piece_sampling.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard-join", drop_near_copies),
    ("suffix-dedup", cut_repeats),
    ("mix", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: trained models and seeded draws have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn; each is written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = scratch(docs, f"stage-{i}-{name}")
    return docs
