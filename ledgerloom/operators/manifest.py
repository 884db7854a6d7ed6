"""Snapshot manifests: which part files a register page announces, and which have not landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The shape of a part file's name.
PART_NAME = r"BasicCompanyData-(\d{4}-\d{2}-\d{2})-part(\d+)_(\d+)\.zip"
PART_TEMPLATE = "BasicCompanyData-%s-part%d_%d.zip"


def snapshot_manifest(pages: DataFrame, html: str = "html") -> DataFrame:
    """All part names of each page's snapshot. Date and total come from the first name on it."""
    others = [c for c in pages.columns if c != html]
    first = F.regexp_extract(F.col(html), PART_NAME, 0)
    seen = pages.select(*others, first.alias("_first")).where(F.col("_first") != "")
    total = F.regexp_extract("_first", PART_NAME, 3).cast("int")
    parts = seen.select(
        *others,
        F.regexp_extract("_first", PART_NAME, 1).alias("snapshot_date"),
        total.alias("total_parts"),
    ).where(F.col("total_parts") >= 1)
    parts = parts.select("*", F.explode(F.sequence(F.lit(1), F.col("total_parts"))).alias("part"))
    name = F.format_string(PART_TEMPLATE, "snapshot_date", "part", "total_parts")
    return parts.withColumn("filename", name)


def missing_parts(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Manifest rows whose ``filename`` is not among the landed ones."""
    return manifest.join(landed.select("filename"), "filename", "left_anti")


def completeness(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """One row: parts landed, parts announced, and whether that is all of them."""
    here = landed.select("filename", F.lit(True).alias("_here")).distinct()
    counts = manifest.join(here, "filename", "left").agg(
        F.count("_here").alias("landed"), F.count("*").alias("total")
    )
    return counts.withColumn("complete", F.col("landed") == F.col("total"))
