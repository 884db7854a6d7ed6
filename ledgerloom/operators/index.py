"""Dense row numbers without a window over the data and without an RDD.

The rows of one input split (or one Parquet file) are numbered inside their task. A table with one
row per split then gets a running total, and the index is offset plus place in the split. That
small table is the size of the split list the Spark driver already holds; it is broadcast only
or joined as Spark sees fit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerloom.session import materialize, scratch_path


def number_rows(rows: DataFrame, keys: list[str], order: list, per: list[str], name: str):
    """``rows`` has ``keys`` and ``_m``, increasing within each key's rows without gaps."""
    sizes = rows.groupBy(*keys).agg(
        F.min("_m").alias("_m0"), F.count("*").alias("_n"), *[o.alias(f"_o{i}") for i, o in enumerate(order)]
    )
    window = Window.partitionBy(*per).orderBy(*[f"_o{i}" for i in range(len(order))])
    running = F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(
        *keys, (F.coalesce(running, F.lit(0)) - F.col("_m0")).alias("_offset")
    )
    offsets = materialize(offsets, "offsets")
    joined = rows.join(offsets, keys)
    return joined.withColumn(name, F.col("_m") + F.col("_offset")).drop("_m", "_offset")


def numbered_lines(
    spark: SparkSession, path: str | list[str], per_file: bool = True, name: str = "line_no"
) -> DataFrame:
    """Text lines as ``file, line_no, value``: 0-based in each file, or over all files by name."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_m"),
        "value",
    )
    per = ["file"] if per_file else []
    order = [F.first("_block")] if per_file else [F.first("file"), F.first("_block")]
    numbered = number_rows(lines, ["file", "_block"], order, per, name)
    return numbered.select("file", name, "value")


def dense_index(df: DataFrame, order_by: list[str], name: str = "idx") -> DataFrame:
    """Number all rows 0, 1, 2, … in the order of the given columns.

    The rows are range-partitioned, sorted inside their partitions and staged as Parquet; file
    name and row position then give the order. A heavy run of equal keys is spread by using all
    of ``order_by`` as the range key, so give enough columns to make it unique.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "sorted")
    df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).write.parquet(path)
    return staged_index(spark, path, df.schema, name)


def staged_index(spark: SparkSession, path: str, schema, name: str = "idx") -> DataFrame:
    """Number the rows of a staged Parquet table in file-name and in-file order."""
    staged = spark.read.schema(schema).parquet(path)
    rows = staged.select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.row_index").alias("_m"),
    )
    order = [F.first(_task()), F.first("_file")]
    return number_rows(rows, ["_file"], order, [], name).drop("_file")


def _task():
    """The task that wrote ``_file``; names alone would sort 100000 before 99999."""
    return F.regexp_extract("_file", r"part-(\d+)", 1).cast("long")


def source_order_index(df: DataFrame, source: str, name: str = "idx") -> DataFrame:
    """Number rows in ``source`` name order, keeping the order in which each source was read.

    For narrow pipelines over unsplittable inputs: a source's rows lie together in one or more
    staged files in the order of their names, so nothing is sorted or shuffled.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "staged")
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    rows = staged.select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.row_index").alias("_m"),
    )
    order = [F.first(source), F.first(_task()), F.first("_file")]
    return number_rows(rows, [source, "_file"], order, [], name).drop("_file")
