"""Exact deduplication by skew-safe combining. DataFrame functions only.

Two texts are equal when they are identical after deleting ``[\\x20\\x09-\\x0D]``. Three levels, each
comparing digest *and* whole content:

1.  every task of the scan combines its own copies (the partial aggregate, grouped by the task's
    salt, so a text leaves a task once however many copies the task holds);
2.  rows with the same digest, content and salt are merged, so a text that fills a third of the
    corpus meets in ``salts`` groups, not one;
3.  the salt winners, at most ``salts`` per text, are combined globally.

The flags go back to the documents by an equi-join on the digest alone, which Spark may split where
a digest is hot; only if two *different* contents share a digest does the join carry the content too.

Defined results: null text is the empty text. A null id ranks behind all ids. Rows that repeat both
id and text are copies like any others: one of them stays. Empty tables give empty tables. Further
columns never take part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.session import materialize

WHITE = r"[\x20\x09-\x0D]+"
SALTS = 16
_STEP = Decimal(2**65)
_TOP = Decimal(2**63)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _rank(length: Column, doc_id: Column) -> Column:
    """One number that is larger for more code points, then for a smaller id; null ids last.

    A decimal stays in the fixed part of an aggregation buffer, so Spark can hash-aggregate it.
    """
    place = F.coalesce(F.lit(_TOP) - doc_id.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return (length.cast("decimal(10,0)") * F.lit(_STEP) + place).cast("decimal(38,0)")


def _rows(docs: DataFrame, doc_id: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.char_length(F.coalesce(F.col(text), F.lit(""))).alias("length"),
        normalised(F.col(text)).alias("content"),
    ).withColumn("digest", digest(F.col("content")))


def text_classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> tuple[DataFrame, list[str]]:
    """``digest, keep_id, keep_length, group_size`` per class of equal texts, as a written table,
    and the columns that tell classes apart (with ``content`` only if digests clash)."""
    rows = _rows(docs, doc_id, text, digest).select(
        "digest",
        "content",
        (F.spark_partition_id() % salts).alias("salt"),
        _rank(F.col("length"), F.col("doc_id")).alias("rank"),
    )
    salted = rows.groupBy("digest", "content", "salt").agg(
        F.max("rank").alias("rank"), F.count("*").alias("n")
    )
    combined = salted.groupBy("digest", "content").agg(
        F.max("rank").alias("rank"), F.sum("n").alias("group_size")
    )
    length = F.floor(F.col("rank") / F.lit(_STEP)).cast("int")
    place = F.col("rank") % F.lit(_STEP)
    classes = combined.select(
        "digest",
        "content",
        F.when(place > 0, F.lit(_TOP) - place).cast("long").alias("keep_id"),
        length.alias("keep_length"),
        "group_size",
    )
    slim = materialize(classes.drop("content"), "text-classes")
    if slim.groupBy("digest").count().where("count > 1").isEmpty():
        return slim, ["digest"]
    return materialize(classes, "text-classes"), ["digest", "content"]


def mark_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    classes, keys = text_classes(docs, doc_id, text, salts, digest)
    sha = F.col("digest") if digest is sha256 else sha256(F.col("content"))
    rows = _rows(docs, doc_id, text, digest).select(
        "doc_id", "length", *keys, F.lower(F.hex(sha)).alias("text_sha256")
    )
    best = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("length") == F.col("keep_length"))
    marked = rows.join(classes, keys).select(
        "doc_id", "keep_id", "group_size", "text_sha256", best.alias("best")
    )
    # The explicit exchange lets Spark split a hot digest in the join below it.
    repeats = Window.partitionBy("doc_id", "text_sha256").orderBy(F.desc("best"))
    return (
        marked.repartition("doc_id", "text_sha256")
        .withColumn("kept", F.col("best") & (F.row_number().over(repeats) == 1))
        .select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    )


def remove_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", salts: int = SALTS
) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were."""
    classes, keys = text_classes(docs, doc_id, text, salts)
    classes = classes.select(
        *[F.col(k).alias(f"_class_{k}") for k in keys],
        F.col("keep_id").alias("_class_keep_id"),
        F.col("keep_length").alias("_class_keep_length"),
    )
    content = normalised(F.col(text))
    of = {"digest": sha256(content), "content": content}
    on = F.col(doc_id).cast("long").eqNullSafe(F.col("_class_keep_id"))
    on &= F.char_length(F.coalesce(F.col(text), F.lit(""))) == F.col("_class_keep_length")
    for key in keys:
        on &= of[key] == F.col(f"_class_{key}")
    kept = docs.join(classes, on, "left_semi")
    ids = docs.groupBy(doc_id).count().where("count > 1")
    # Only rows that repeat an id can both be the best of their class.
    return kept if ids.isEmpty() else kept.dropDuplicates([doc_id, text])
