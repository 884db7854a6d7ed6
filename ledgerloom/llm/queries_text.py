"""Queries of the operators that work on texts inside Arrow tasks."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import bpe_words
from ledgerloom.llm.bpe import round_trip, token_digests
from ledgerloom.llm.jaccard_join import similarity_classes
from ledgerloom.llm.line_dedup import remove_aligned_lines
from ledgerloom.llm.mixing import mix_sources
from ledgerloom.llm.quality import score_documents
from ledgerloom.llm.registry import query, table
from ledgerloom.llm.suffix_dedup import remove_repeats

RANKS = "byte_bpe_multi_50k.tiktoken"
WORDS = "word_bpe_49k.json"


@query("op1_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op3_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return token_digests(round_trip(documents, public_tokenizers.path(RANKS)))


@query("op13_word_bpe")
def word_bpe(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return bpe_words.token_digests(bpe_words.round_trip(documents, public_tokenizers.path(WORDS)))


@query("op10_source_mixing")
def source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix_sources(table(spark, folder, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "repeats", "taken")


JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) >= 4
      THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM words),
entries AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c, any_value(x.n) AS n, any_value(y.n) AS m
    FROM entries x JOIN entries y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  WHERE 100 * c >= 85 * (n + m - c)),
reach AS (
  SELECT a, b FROM links
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, len(s) AS n_shingles,
  least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS component_id
FROM sets
"""


@query("op5_ngram_jaccard", JACCARD_SQL)
def ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return similarity_classes(table(spark, folder, "documents"))


@query("op7_suffix_dedup")
def suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeats(table(spark, folder, "documents"))
    removed = F.aggregate(
        "removed", F.lit(0).cast("long"), lambda total, r: total + r["high"] - r["low"]
    )
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op2_line_dedup")
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_aligned_lines(table(spark, folder, "documents"), every_holder=True)
    return found.select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
