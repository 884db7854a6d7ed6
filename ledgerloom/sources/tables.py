"""Delimited sources: typed CSV, many CSVs united by column name, zipped CSV parts, split tables."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerloom.session import materialize
from ledgerloom.sources import zips

# Cell texts read as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The agreement levels of the labelled-sentence dataset, and its file name.
PHRASEBANK_CONFIGS = (
    "sentences_allagree", "sentences_75agree", "sentences_66agree", "sentences_50agree",
)
PHRASEBANK_FILE = "financial_phrasebank_{config}.csv"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    infer: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """CSV with a header, quoted newlines and doubled quotes.

    Missing-value texts become null before types are inferred, so ``NA`` does not turn a number
    column into text. With a ``schema`` there is no inference pass. ``multi_line=False`` lets
    Spark split large files, if no cell holds a newline.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if schema is not None:
        typed = reader.option("nullValue", "").schema(schema).csv(path)
        text = {f.name for f in typed.schema if isinstance(f.dataType, T.StringType)}
        return typed.select(
            *[_missing_to_null(c) if c in text else F.col(f"`{c}`") for c in typed.columns]
        )
    raw = reader.csv(path)
    cells = raw.select(*[_missing_to_null(c) for c in raw.columns])
    return infer_types(cells) if infer else cells


def _missing_to_null(name: str):
    column = F.col(f"`{name}`")
    return F.when(~column.isin(*NA_TOKENS), column).alias(name)


def type_checks(cells: Column) -> dict[str, Column]:
    """Aggregates over a column's texts: whether all that are present are whole numbers (``l``), numbers
    (``d``) or truth values (``b``)."""
    c = F.trim(cells)
    present = c.isNotNull()
    number = c.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z|^[+-]?(?i:inf|infinity)\z")
    whole = c.rlike(r"^[+-]?\d+\z") & c.try_cast("long").isNotNull()
    truth = c.isin("True", "TRUE", "true", "False", "FALSE", "false")
    every = lambda test: F.coalesce(F.bool_and(F.when(present, test)), F.lit(False))
    return {"l": every(whole), "d": every(number), "b": every(truth)}


def infer_types(df: DataFrame) -> DataFrame:
    """Cast text columns to long, double or boolean where every present value allows it.

    One aggregate over all columns decides.
    """
    checks = [
        f.alias(f"{kind}{i}")
        for i, name in enumerate(df.columns)
        for kind, f in type_checks(F.col(f"`{name}`")).items()
    ]
    if not checks:
        return df
    verdict = df.agg(*checks).first()
    out = []
    for i, name in enumerate(df.columns):
        c = F.col(f"`{name}`")
        if verdict[f"l{i}"]:
            c = F.trim(c).try_cast("long")
        elif verdict[f"d{i}"]:
            c = F.trim(c).try_cast("double")
        elif verdict[f"b{i}"]:
            c = F.lower(F.trim(c)).try_cast("boolean")
        out.append(c.alias(name))
    return df.select(*out)


def read_phrasebank(spark: SparkSession, folder: str, config: str = "sentences_allagree") -> DataFrame:
    """The labelled sentences of one agreement level."""
    if config not in PHRASEBANK_CONFIGS:
        raise ValueError(f"unknown config {config!r}, choose from {PHRASEBANK_CONFIGS}")
    path = f"{folder.rstrip('/')}/{PHRASEBANK_FILE.format(config=config)}"
    try:
        return read_csv(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no data for config {config!r} at {path}") from e


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """``file, header, cells`` of all CSV files below ``path``: each one's first line, and where a quote in
    it stays open, the cells of the first record."""
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
            "value",
        )
    )
    headers = (
        lines.where(F.col("block") == 0)
        .groupBy("file")
        .agg(F.min_by("value", "place").alias("header"))
    )
    headers = materialize(headers, "csv-headers")
    # An odd number of quotes: the header goes on in the next line, so it is read as a record.
    open_end = F.regexp_count("header", F.lit('"')) % 2 == 1
    broken = [r.file for r in headers.where(open_end).collect()]
    if broken:
        cells = spark.read.option("escape", '"').option("multiLine", True).csv(broken)
        record = F.array(*[F.col(f"`{c}`") for c in cells.columns])
        # Files with more columns make the others' records longer.
        filled = F.array_position(F.reverse(F.transform(record, lambda c: c.isNotNull())), True)
        record = F.slice(record, F.lit(1), F.size(record) + 1 - filled.cast("int"))
        records = cells.select(
            F.col("_metadata.file_path").alias("file"),
            F.monotonically_increasing_id().alias("place"),
            record.alias("value"),
        )
        whole = records.groupBy("file").agg(F.min_by("value", "place").alias("cells"))
        headers = headers.join(whole, "file", "left")
    else:
        headers = headers.withColumn("cells", F.lit(None).cast("array<string>"))
    return headers


def header_names(header: Column, record: Column, most: int) -> Column:
    """A header's column names as Spark's reader gives them: empty ones and repeated ones get their
    place. ``record`` has the cells where the header line does not; ``most`` is at least their number."""
    fields = ", ".join(f"c{i} string" for i in range(most))
    cells = F.from_csv(header, fields, {"escape": '"'})
    # How many there are: what follows the last name is absent, but so may be a name.
    count = F.size(F.split(F.regexp_replace(header, r'"(?:[^"]|"")*"', ""), ","))
    names = F.slice(F.array(*[cells[f"c{i}"] for i in range(most)]), F.lit(1), count)
    names = F.coalesce(record, names)
    blank = lambda n: F.coalesce(n, F.lit("")) == ""
    alike = lambda n: F.size(F.filter(names, lambda x: F.lower(x) == F.lower(n))) > 1

    def safe(n: Column, i: Column) -> Column:
        place = i.cast("string")
        return F.when(blank(n), F.concat(F.lit("_c"), place)).when(alike(n), F.concat(n, place)).otherwise(n)

    return F.transform(names, safe)


def csv_cells(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """All CSV files below ``path`` in one scan, whatever their columns: ``file, values`` per record, and
    ``file, names`` per file. ``values`` are by place; missing-value texts are null."""
    headers = csv_headers(spark, path)
    commas = F.greatest(F.size(F.split("header", ",")), F.coalesce(F.size("cells"), F.lit(0)))
    most = headers.agg(F.max(commas)).first()[0] or 1
    fields = [f"c{i}" for i in range(most)]
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
    reader = reader.option("header", True).option("escape", '"').option("multiLine", True)
    cells = reader.schema(", ".join(f"{c} string" for c in fields)).csv(path)
    cells = cells.select(
        F.col("_metadata.file_path").alias("file"), F.array(*[_missing_to_null(c) for c in fields]).alias("values")
    )
    names = headers.select("file", header_names(F.col("header"), F.col("cells"), most).alias("names"))
    return cells, materialize(names, "csv-names")


def read_csv_tree(
    spark: SparkSession, path: str, infer: bool = True, staged: bool = False
) -> DataFrame:
    """All CSV files below ``path``, united by column name.

    ``staged`` parses the files once into a Parquet table that type inference and later steps
    read; use it when several follow.

    A plain multi-path read would bind columns by position, so all files are read by place in one
    scan, and a table of the files' headers, joined by file, tells which place a column has. The
    driver holds column names, no file names.
    """
    cells, names = csv_cells(spark, path)
    # Names that differ in case only are one column, as in any union by name.
    columns = names.select("file", F.posexplode("names").alias("pos", "column"))
    columns = columns.groupBy(F.lower("column").alias("key")).agg(
        F.min(F.struct("file", "pos", "column")).alias("first")
    )
    wanted = [r.column for r in columns.orderBy("first").select("first.column").collect()]
    if not wanted:
        return spark.createDataFrame([], T.StructType([]))
    low = F.transform("names", lambda n: F.lower(n))
    keys = F.array(*[F.lower(F.lit(c)) for c in wanted])
    places = F.transform(keys, lambda k: F.array_position(low, k).cast("int"))
    joined = cells.join(names.select("file", places.alias("places")), "file")
    place = lambda i: F.nullif(F.col("places")[i], F.lit(0)) - 1
    cells = joined.select(*[F.get("values", place(i)).alias(c) for i, c in enumerate(wanted)])
    if staged:
        cells = materialize(cells, "cells")
    return infer_types(cells) if infer else cells


def _first_csvs(spark: SparkSession, path: str) -> DataFrame | None:
    """The first ``.csv`` of every zip directly in ``path``, as rows of ``zips.members``."""
    found = zips.members(spark, path)
    if found is None:
        return None
    csvs = found.where(F.col("member").endswith(".csv"))
    return csvs.groupBy("path").agg(F.min_by(F.struct(*csvs.columns), "place").alias("first")).select("first.*")


def _csv_columns(spark: SparkSession, path: str, csvs: DataFrame) -> list[str]:
    def headers(part, stream):
        names = list(pd.read_csv(stream, dtype=str, nrows=0).columns)
        yield pd.DataFrame({"part": part, "pos": range(len(names)), "name": names})

    schema = T.StructType().add("part", "string").add("pos", "long").add("name", "string")
    named = zips.read_members(spark, path, csvs, headers, schema)
    first = named.groupBy("name").agg(F.min(F.struct("part", "pos")).alias("at"))
    return [row.name for row in first.orderBy("at").collect()]


def zip_csv_columns(spark: SparkSession, path: str) -> list[str]:
    """The column names of all parts, in order of first appearance by part name."""
    csvs = _first_csvs(spark, path)
    return [] if csvs is None else _csv_columns(spark, path, csvs)


def read_zip_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    part_column: str | None = None,
    chunk_rows: int = 20_000,
) -> DataFrame:
    """The first ``.csv`` of every zip in ``path``, all columns as text, united by name.

    A compressed member can only be read from its start, so each is read by one task, but as a
    stream: neither archive nor member has to fit anywhere. Name the ``columns`` you need: the
    optimizer cannot prune inside Python, and without them a first pass over the parts collects their
    headers. ``part_column`` adds the part's name.
    """
    csvs = _first_csvs(spark, path)
    if csvs is None:
        return spark.createDataFrame([], T.StructType([]))
    wanted = list(columns) if columns is not None else _csv_columns(spark, path, csvs)
    if not wanted:
        return spark.createDataFrame([], T.StructType([]))
    fields = ([part_column] if part_column else []) + wanted
    schema = T.StructType([T.StructField(c, T.StringType()) for c in fields])

    def rows(part, stream):
        first: list[str] = []

        def present(name):
            # One column at least, or the part's rows would not be counted.
            first.append(name)
            return name in wanted or name == first[0]

        for chunk in pd.read_csv(stream, dtype=str, usecols=present, chunksize=chunk_rows):
            chunk = chunk.reindex(columns=wanted).astype(object)
            chunk = chunk.where(chunk.notna(), None)
            if part_column:
                chunk.insert(0, part_column, part)
            yield chunk

    return zips.read_members(spark, path, csvs, rows, schema)


# Names a split may be asked for by.
SPLIT_ALIASES = {"val": "val", "validation": "val"}


def read_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A split-partitioned table, whole or one split; other splits' files are not read.

    A split that the table does not have is an error.
    """
    table = spark.read.parquet(path)
    if not split:
        return table
    chosen = table.where(F.col("split") == SPLIT_ALIASES.get(split, split))
    if chosen.isEmpty():
        raise ValueError(f"no split {split!r} in {path}")
    return chosen
