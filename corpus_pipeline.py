"""Documents to token ids: quality, exact and near duplicates, mixing, tokens.

Every stage takes all rows its predecessor kept, and is written as Parquet before the next reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.bpe import round_trip
from ledgerloom.llm.exact_dedup import remove_duplicates
from ledgerloom.llm.jaccard_join import keep_one_per_class
from ledgerloom.llm.mixing import mix_sources, mixed_documents
from ledgerloom.llm.quality import keep_good
from ledgerloom.llm.registry import table
from ledgerloom.session import materialize

RANKS = "byte_bpe_multi_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal texts."""
    return remove_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts."""
    return keep_one_per_class(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs, mix_sources(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded_sha256`` of every document in the mix."""
    coded = round_trip(docs, public_tokenizers.path(RANKS))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixing),
    ("byte-level BPE encoding and decoding", tokens),
]

# Discriminant, balanced sampling and token ids are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
