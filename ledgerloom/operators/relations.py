"""Relation examples from parallel sentence and triple lines."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.functions import text as T
from ledgerloom.operators.index import numbered_lines
from ledgerloom.sources.records import line_set


def pair_lines(sentences: DataFrame, triples: DataFrame) -> DataFrame:
    """``line_no, tup, sent``: every triple line with the sentence of the same number.

    A triple line without a sentence is an error; surplus sentences are ignored.
    """
    s = sentences.select("line_no", F.col("value").alias("sent"))
    t = triples.select("line_no", F.col("value").alias("tup"))
    missing = F.raise_error(F.concat(F.lit("no sentence for line "), F.col("line_no")))
    return t.join(s, "line_no", "left").select(
        "line_no", "tup", F.coalesce("sent", missing.cast("string")).alias("sent")
    )


def split_triples(pairs: DataFrame) -> DataFrame:
    """One row per '|'-separated triple of the non-blank lines, with its ';'-separated ``parts``."""
    line = T.strip(F.col("tup"))
    filled = pairs.where(line != "")
    # Cut into parts before the rows are made, so that later filters read finished columns.
    triples = F.transform(
        F.split(line, r"[|]"),
        lambda t: F.struct(
            T.strip(t).alias("triple"), F.transform(F.split(t, ";"), T.strip).alias("parts")
        ),
    )
    return filled.select(F.col("line_no").alias("sent_id"), "sent", F.inline(triples))


def relation_examples(pairs: DataFrame, valid: DataFrame) -> DataFrame:
    """Well-formed triples whose relation is in ``valid`` (one column ``relation``)."""
    formed = split_triples(pairs).where(F.size("parts") == 3)
    examples = formed.select(
        T.words(F.col("sent")).alias("tokens"),
        F.get("parts", F.lit(0)).alias("head_text"),
        F.get("parts", F.lit(1)).alias("tail_text"),
        F.get("parts", F.lit(2)).alias("relation"),
        "sent_id",
    )
    return examples.join(valid.select("relation"), "relation", "left_semi").select(
        "tokens", "head_text", "tail_text", "relation", "sent_id"
    )


def rejected_triples(pairs: DataFrame, valid: DataFrame) -> DataFrame:
    """The triples :func:`relation_examples` leaves out, and why."""
    known = valid.select("relation", F.lit(True).alias("_known")).distinct()
    parts = split_triples(pairs).withColumn("relation", F.get("parts", F.lit(2)))
    judged = parts.join(known, "relation", "left")
    reason = F.when(F.size("parts") != 3, "malformed").when(
        F.col("_known").isNull(), "unknown relation"
    )
    return judged.select("sent_id", "triple", reason.alias("reason")).where(
        F.col("reason").isNotNull()
    )


def load_splits(
    spark: SparkSession, folder: str, splits: Sequence[str] = ("train", "dev", "test")
) -> DataFrame:
    """The examples of several splits, with a column ``split``."""
    parts = [load_relations(spark, s, folder).withColumn("split", F.lit(s)) for s in splits]
    return reduce(DataFrame.unionByName, parts)


def examples_per_split(examples: DataFrame) -> DataFrame:
    """``split, n``."""
    return examples.groupBy("split").agg(F.count("*").alias("n"))


def load_relations(spark: SparkSession, split: str, folder: str) -> DataFrame:
    """The examples of ``<split>.sent`` / ``<split>.tup`` with ``relations.txt`` in ``folder``."""
    base = folder.rstrip("/")
    pairs = pair_lines(
        numbered_lines(spark, f"{base}/{split}.sent", per_file=False),
        numbered_lines(spark, f"{base}/{split}.tup", per_file=False),
    )
    return relation_examples(pairs, line_set(spark, f"{base}/relations.txt", "relation"))
