"""File listings as tables. Only paths and sizes are read, never file contents."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F

from ledgerloom.session import scratch_path

CARD_FILE = "dataset_card.json"


def load_direct(reader: DataFrameReader, path: str, glob: str) -> DataFrame | None:
    """The files directly in ``path`` that match ``glob``; null if there are none.

    Naming the files keeps sub-folders, such as a job's own output, out of the scan.
    """
    try:
        return reader.load(f"{path.rstrip('/')}/{glob}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``path, length`` of every file below ``path``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length")


LISTED_ROWS = 50_000
_LISTING = "dataset string, relative string, length long, folder boolean"


def dataset_files(spark: SparkSession, base: str, batch: int = LISTED_ROWS) -> DataFrame:
    """``dataset, relative, length, folder`` for all files and folders in each folder of ``base``.

    The file system itself is asked, as Spark's readers pass over names that begin with ``_`` or
    ``.`` and over empty folders. Only the driver can ask it, but it keeps nothing of the answer: it walks
    depth first over open listings, one per level, and writes every ``batch`` rows to a table, so its
    memory does not grow with the files. A folder of ``base`` without files has one row with an empty
    ``relative``. Cards written by an earlier run are left out, so profiling twice gives the same
    sizes.
    """
    path = scratch_path(spark, "listing")
    rows: list[tuple[str, str, int, bool]] = []

    def write() -> None:
        spark.createDataFrame(rows, _LISTING).coalesce(1).write.mode("append").parquet(path)
        rows.clear()

    for row in _entries(spark, base):
        rows.append(row)
        if len(rows) >= batch:
            write()
    write()
    return spark.read.schema(_LISTING).parquet(path)


def _entries(spark: SparkSession, base: str) -> Iterator[tuple[str, str, int, bool]]:
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(base)
    system = root.getFileSystem(context._jsc.hadoopConfiguration())
    levels = [(system.listStatusIterator(root), None)]  # a folder's open listing, and its name parts
    while levels:
        listing, names = levels[-1]
        if not listing.hasNext():
            levels.pop()
            continue
        entry = listing.next()
        folder = entry.isDirectory()
        if names is None:
            if not folder:
                continue
            below = (entry.getPath().getName(),)
        else:
            below = (*names, entry.getPath().getName())
        relative = "/".join(below[1:])
        if folder:
            levels.append((system.listStatusIterator(entry.getPath()), below))
        # Cards written by an earlier run do not count.
        if relative != CARD_FILE:
            yield below[0], relative, 0 if folder else entry.getLen(), folder


def dataset_of(spark: SparkSession, base: str, file: Column) -> Column:
    """The folder of ``base`` that a scanned ``file`` (its ``_metadata.file_path``) lies in."""
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(base)
    system = root.getFileSystem(context._jsc.hadoopConfiguration())
    inside = system.makeQualified(root).toUri().getRawPath().rstrip("/") + "/"
    below = F.substring_index(F.substr(file, F.instr(file, F.lit(inside)) + len(inside)), "/", 1)
    return F.url_decode(F.replace(below, F.lit("+"), F.lit("%2B")))


def dataset_sizes(files: DataFrame) -> DataFrame:
    """Per dataset: bytes, and the format that decides how it is profiled.

    CSV wins over JSONL; otherwise ``files`` counts all files and folders below.
    """
    has = lambda end: F.max(F.col("relative").endswith(end) & ~F.col("folder"))
    sizes = files.groupBy("dataset").agg(
        F.sum("length").alias("size_bytes"),
        F.count_if(F.col("relative") != "").alias("_entries"),
        has(".csv").alias("_csv"),
        has(".jsonl").alias("_jsonl"),
    )
    kind = F.when(F.col("_csv"), "csv").when(F.col("_jsonl"), "jsonl").otherwise("other")
    total = F.col("_entries")
    return sizes.select(
        "dataset",
        "size_bytes",
        kind.alias("format"),
        F.when(kind == "other", total).alias("files"),
    )
