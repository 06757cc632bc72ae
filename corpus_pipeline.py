"""From raw documents to token ids, one stage after the other.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the
shared folder and hands what it reads back to the next stage. All stages but the last return the
columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from newsflow.llm import dedup, mixing, pieces, quality, simhash
from newsflow.operators.scratch import written

# Shares of the sources in proportion to their tokens to this power. No source loses tokens and no
# document falls below one copy, so that nothing clean that came this far is lost.
TEMPER = 0.7


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality scorer keeps."""
    return quality.drop_low_quality(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return dedup.drop_exact_copies(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints over four-word shingles, linked at four or
    fewer differing bits."""
    return simhash.drop_near_copies(docs, words=4, bits=4)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target shares of the sources ask for."""
    return mixing.mix(docs, temper=TEMPER, low=1.0, raise_only=True)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text that they decode to."""
    return pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("source_mixing", source_mixing),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

# Label model, classifiers, fingerprints and encoding are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
