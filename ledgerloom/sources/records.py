"""Line-based and feed sources: tolerant JSONL, line counts, line sets, RSS entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.functions.entities import bind
from ledgerloom.functions.text import non_blank, strip
from ledgerloom.operators.extract import ANNOUNCEMENT_FIELDS
from ledgerloom.operators.index import number_rows, numbered_lines
from ledgerloom.sources.listing import load_direct


def _parsed(line: Column) -> Column:
    """The one JSON object on a line as an array of one, or an empty array.

    All fields are read as text, so a badly typed field does not lose its record; the brackets
    make trailing text an error.
    """
    fields = ", ".join(f"{c} string" for c in [*ANNOUNCEMENT_FIELDS, "_metadata"])
    array = F.from_json(F.concat(F.lit("["), line, F.lit("]")), f"array<struct<{fields}>>")
    none = F.array().cast(f"array<struct<{fields}>>")
    one = bind(array, lambda a: F.when((F.size(a) == 1) & F.get(a, F.lit(0)).isNotNull(), a))
    return F.coalesce(one, none)


# Landed files, and what this library's own sink writes.
JSONL_FILES = "{*.jsonl,part-*.json}"


def _json_lines(spark: SparkSession, path: str, glob: str) -> DataFrame:
    reader = spark.read.format("text").option("ignoreCorruptFiles", "true")
    lines = load_direct(reader, path, glob)
    if lines is None:
        schema = "file string, ord struct<file: string, block: long, line: long>, value string"
        return spark.createDataFrame([], schema)
    place = F.struct(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return lines.select(
        F.col("_metadata.file_name").alias("file"), place.alias("ord"), "value"
    ).where(non_blank(F.col("value")))


METADATA_SCHEMA = (
    "total_records bigint, scraped_at string, sources map<string,bigint>, rns_types map<string,bigint>, "
    "companies_identified bigint, tickers_identified bigint, unique_companies bigint, unique_tickers bigint"
)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The metadata beside a run's records; its counters may fill several rows
    (``profile.counter_values``)."""
    return spark.read.schema(METADATA_SCHEMA).json(path)


def read_announcements(
    spark: SparkSession,
    path: str,
    drop_metadata_rows: bool = True,
    keep_file: bool = False,
    keep_order: bool = False,
    glob: str = JSONL_FILES,
) -> DataFrame:
    """Announcement records of all JSONL files in ``path``; blank and invalid lines are skipped.

    ``keep_order`` adds ``ord``, which sorts by file name and then by line.
    """
    found = _parsed(F.col("value"))
    if drop_metadata_rows:
        found = F.filter(found, lambda r: r["_metadata"].isNull())
    # Filtered inside the array, so that each line is parsed once.
    good = _json_lines(spark, path, glob).select("file", "ord", F.explode(found).alias("_r"))
    fields = [
        F.col(f"_r.{c}").try_cast("int").alias(c) if c == "source_priority" else F.col(f"_r.{c}")
        for c in ANNOUNCEMENT_FIELDS
    ]
    extra = (["file"] if keep_file else []) + (["ord"] if keep_order else [])
    return good.select(*extra, *fields)


def unread_files(spark: SparkSession, path: str, glob: str = JSONL_FILES) -> DataFrame:
    """``file`` of every file that holds bytes but gave no line: skipped as unreadable."""
    reader = spark.read.format("binaryFile")
    files = load_direct(reader, path, glob)
    if files is None:
        return spark.createDataFrame([], "file string")
    names = files.where("length > 0").select(F.substring_index("path", "/", -1).alias("file"))
    text = load_direct(spark.read.format("text").option("ignoreCorruptFiles", "true"), path, glob)
    read = text.select(F.col("_metadata.file_name").alias("file")).distinct()
    return names.join(read, "file", "left_anti")


def jsonl_line_report(spark: SparkSession, path: str, glob: str = JSONL_FILES) -> DataFrame:
    """Per file: records read and lines rejected."""
    lines = _json_lines(spark, path, glob).withColumn("_ok", F.size(_parsed(F.col("value"))) == 1)
    return lines.groupBy("file").agg(
        F.count_if("_ok").alias("records"), F.count_if(~F.col("_ok")).alias("bad_lines")
    )


def rejected_lines(spark: SparkSession, path: str, glob: str = JSONL_FILES) -> DataFrame:
    """``file, line_no (1-based), value`` of every invalid line."""
    lines = numbered_lines(spark, f"{path.rstrip('/')}/{glob}")
    bad = lines.where(non_blank(F.col("value")) & (F.size(_parsed(F.col("value"))) == 0))
    name = F.substring_index("file", "/", -1)
    return bad.select(name.alias("file"), (F.col("line_no") + 1).alias("line_no"), "value")


def jsonl_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file`` of every physical line of all ``*.jsonl`` below ``path``, blank and header lines included."""
    lines = spark.read.option("pathGlobFilter", "*.jsonl").option("recursiveFileLookup", "true")
    return lines.text(path).select(F.col("_metadata.file_path").alias("file"))


def jsonl_line_count(spark: SparkSession, path: str) -> DataFrame:
    """How many lines ``jsonl_lines`` has."""
    return jsonl_lines(spark, path).agg(F.count("*").alias("num_rows"))


def line_set(spark: SparkSession, path: str, name: str = "value") -> DataFrame:
    """Distinct non-blank lines, trimmed."""
    lines = spark.read.text(path).select(strip(F.col("value")).alias(name))
    return lines.where(F.col(name) != "").distinct()


FEED_SCHEMA = (
    "title string, link string, pubDate string, description string, category array<string>, "
    "guid struct<_VALUE: string>"
)


ITEM = "<item"
_BEGINS = r"^[\s>]"


def _feed_parts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file_path, file, n, value``: what stands between the openings of entries, numbered per file; part
    0 is what stands before the first. Spark cuts a file into splits and gives a split the parts that
    begin in it, so one feed is read by many tasks."""
    parts = spark.read.option("lineSep", ITEM).text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_m"),
        "value",
    )
    return number_rows(parts, ["file_path", "_block"], [F.first("_block")], ["file_path"], "n")


def _feed_items(spark: SparkSession, path: str) -> DataFrame:
    """``file, pos, value, item`` per entry; ``item._corrupt`` is set where it is not well-formed.

    Each entry is parsed on its own: a broken one takes nothing else with it. Feeds in which ``<item``
    also begins other names are few; these are read as one row each.
    """
    parts = _feed_parts(spark, path).where("n > 0")
    begins = F.col("value").rlike(_BEGINS)
    odd = [r.file_path for r in parts.where(~begins).select("file_path").distinct().collect()]
    whole = lambda p: F.regexp_extract(p, r"(?s)^.*?</item\s*>", 0)
    entry = lambda p: F.coalesce(F.nullif(whole(p), F.lit("")), p)
    rows = parts.where(~F.col("file_path").isin(odd)) if odd else parts
    opened = F.concat(F.lit(ITEM), F.col("value"))
    rows = rows.select("file", (F.col("n") - 1).alias("pos"), entry(opened).alias("value"))
    if odd:
        feeds = spark.read.text(odd, wholetext=True)
        begun = F.filter(F.split("value", r"(?=<item[\s>])"), lambda p: p.rlike(r"^<item[\s>]"))
        found = F.posexplode(F.transform(begun, entry)).alias("pos", "value")
        rows = rows.unionByName(feeds.select(F.col("_metadata.file_name").alias("file"), found))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "rowTag": "item"}
    item = F.from_xml("value", f"{FEED_SCHEMA}, _corrupt string", options)
    return rows.withColumn("item", item)


def rejected_entries(spark: SparkSession, path: str) -> DataFrame:
    """``file, value`` of the entries that are not well-formed."""
    return _feed_items(spark, path).where("item._corrupt IS NOT NULL").select("file", "value")


def read_feed(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """RSS entries as ``file, pos, title, link, published, summary, category, guid``.

    ``limit`` keeps the first entries of each feed file. What cannot be parsed is in
    :func:`rejected_entries`; it keeps its place in ``pos``.
    """
    placed = _feed_items(spark, path).where("item._corrupt IS NULL")
    if limit is not None:
        placed = placed.where(F.col("pos") < limit)
    return placed.select(
        "file",
        F.col("pos").cast("long").alias("pos"),
        F.col("item.title").alias("title"),
        F.col("item.link").alias("link"),
        F.col("item.pubDate").alias("published"),
        F.col("item.description").alias("summary"),
        F.get("item.category", F.lit(0)).alias("category"),
        F.col("item.guid._VALUE").alias("guid"),
    )
