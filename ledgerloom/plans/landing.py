"""Landed files made from tables by Spark tasks, for queries that read file formats."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.session import scratch_path


def write_lines(df: DataFrame, key: str, line: Column, label: str) -> str:
    """One text line per row, in ``key`` order over the files' names."""
    path = scratch_path(df.sparkSession, label)
    ordered = df.repartitionByRange(key).sortWithinPartitions(key)
    ordered.select(line.alias("value")).write.text(path)
    return path


def land(files: DataFrame, folder: str) -> None:
    """Write rows ``name, content`` as files of these names below ``folder``."""

    def put(rows):
        from pyarrow import fs

        target, base = fs.FileSystem.from_uri(folder.replace("file:/", "/", 1))
        for name, content in rows:
            path = f"{base}/{name}"
            target.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with target.open_output_stream(path) as out:
                out.write(content)

    # An Arrow batch would hold thousands of whole files; rows come in pieces of a few MB.
    files.select("name", "content").foreachPartition(put)


def zip_parts(df: DataFrame, key: str, rows_per_part: int) -> DataFrame:
    """``name, content`` of zips with one CSV each; a part holds ``rows_per_part`` keys."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf["_part"].iloc[0])
        text = pdf.sort_values(key).drop(columns="_part").to_csv(index=False)
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("readme.txt", "no table")
            archive.writestr(f"data_{part}.csv", text)
        return pd.DataFrame({"name": [f"part_{part:05d}.zip"], "content": [buffer.getvalue()]})

    parts = df.withColumn("_part", F.floor(F.col(key) / rows_per_part))
    return parts.groupBy("_part").applyInPandas(pack, "name string, content binary")


def line_files(
    df: DataFrame, key: str, line: Column, rows_per_file: int, name: str, head: str = "", foot: str = ""
) -> DataFrame:
    """``name, content`` of text files named by the pattern ``name``, ``rows_per_file`` keys each."""
    numbered = df.select(
        F.floor(F.col(key) / rows_per_file).alias("_file"), F.col(key).alias("_key"), line.alias("_line")
    )
    lines = F.array_sort(F.collect_list(F.struct("_key", "_line")))
    text = F.array_join(F.transform(lines, lambda x: F.concat(x["_line"], F.lit("\n"))), "")
    whole = F.concat(F.lit(head), text, F.lit(foot))
    return numbered.groupBy("_file").agg(F.encode(whole, "UTF-8").alias("content")).select(
        F.format_string(name, "_file").alias("name"), "content"
    )
