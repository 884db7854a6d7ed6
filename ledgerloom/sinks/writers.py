"""Sinks. All of them write in parallel; none collects rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.text import one_decimal
from ledgerloom.operators import index
from ledgerloom.operators.profile import run_metadata
from ledgerloom.sources.tables import PHRASEBANK_FILE


def run_name(now: dt.datetime | None = None) -> str:
    """Fixed format of a collection run's name, stamped in UTC."""
    now = now or dt.datetime.now(dt.timezone.utc)
    return f"rns_working_{now:%Y%m%d_%H%M%S}"


def write_announcements(
    records: DataFrame, out_dir: str, now: dt.datetime | None = None
) -> str:
    """Records as JSON lines under ``<run>/records`` and one metadata object beside them.

    The metadata is no line among the records, so no reader takes it for one.
    """
    now = now or dt.datetime.now(dt.timezone.utc)
    out = f"{out_dir.rstrip('/')}/{run_name(now)}"
    records.write.option("ignoreNullFields", False).json(f"{out}/records")
    stored = records.sparkSession.read.schema(records.schema).json(f"{out}/records")
    run_metadata(stored, now.isoformat()).coalesce(1).write.json(f"{out}/metadata")
    return out


def write_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


def write_phrasebank(df: DataFrame, folder: str, config: str) -> str:
    """Labelled sentences with their label names, where ``read_phrasebank`` looks for them."""
    return write_csv(df, f"{folder.rstrip('/')}/{PHRASEBANK_FILE.format(config=config)}")


def write_shards(
    df: DataFrame,
    out_dir: str,
    shard_size: int = 200_000,
    order_by: list[str] | None = None,
    source: str | None = None,
) -> str:
    """Contiguous shards of ``shard_size`` rows in ``part=part_00000``, ``part_00001``, …

    The order is that of ``order_by``, or the reading order of ``source`` parts. Each task holds a
    run of consecutive rows, so it writes to few shards and no further shuffle is needed.
    """
    if (order_by is None) == (source is None):
        raise ValueError("give either order_by or source")
    if order_by is not None:
        numbered = index.dense_index(df, order_by, "_idx")
    else:
        numbered = index.source_order_index(df, source, "_idx").drop(source)
    shard = F.format_string("part_%05d", F.floor(F.col("_idx") / shard_size).cast("long"))
    shards = numbered.withColumn("part", shard).drop("_idx")
    shards.write.partitionBy("part").parquet(out_dir)
    return out_dir


def write_splits(df: DataFrame, out_dir: str) -> str:
    """One directory per split."""
    df.write.partitionBy("split").parquet(out_dir)
    return out_dir


def write_cards(cards: DataFrame, out_dir: str) -> str:
    """One JSON card per dataset, in its dataset's directory."""
    cards.withColumn("dataset", F.col("name")).write.partitionBy("dataset").json(out_dir)
    return out_dir


def overview(cards: DataFrame) -> DataFrame:
    """The overview table: one row per dataset, formatted, by name."""
    dash = F.lit("-")
    return cards.select(
        F.col("name").alias("dataset"),
        F.coalesce(F.format_number("num_rows", 0), dash).alias("rows"),
        one_decimal(F.col("size_bytes") / 1e6).alias("size_mb"),
        F.coalesce("ideal_use", dash).alias("ideal_use"),
    ).orderBy("dataset")


def overview_markdown(cards: DataFrame) -> DataFrame:
    """The overview as lines of a Markdown table, with ``line_no``."""
    row = F.format_string("| `%s` | %s | %s | %s |", "dataset", "rows", "size_mb", "ideal_use")
    spark = cards.sparkSession
    head = spark.createDataFrame(
        [
            (0, "", "# Data Overview"),
            (1, "", ""),
            (2, "", "| Dataset | Rows | Size (MB) | Ideal Use |"),
            (3, "", "|---|---|---|---|"),
        ],
        "block int, name string, line string",
    )
    body = overview(cards).select(F.lit(4).alias("block"), F.col("dataset").alias("name"), row.alias("line"))
    return head.unionByName(body).orderBy("block", "name").select("line")
