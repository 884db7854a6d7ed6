"""Queries over vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.lsh_search import nearest
from ledgerloom.llm.registry import query, table
from ledgerloom.llm.whitening import whiten


@query("op8_multiprobe_search")
def multiprobe_search(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op11_whitening")
def whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))
