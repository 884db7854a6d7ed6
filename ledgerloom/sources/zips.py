"""Zip archives as streams: no task ever holds one whole.

Spark reads an archive as lines of bytes, which it splits like any text file; a task then gets the
lines of one archive in order, from a sort that spills, and takes from them what it needs. The
first pass keeps an archive's end, where its directory is, and makes a table of members (archive,
member, offset, sizes). The second goes to a member's offset and inflates it piece by piece.
"""

from __future__ import annotations

import bz2
import io
import zipfile
import zlib
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledgerloom.session import materialize
from ledgerloom.sources.listing import load_direct

# A directory holds some hundred bytes per member; a larger one than this is an error.
END_BYTES = 1 << 24
_READ = 1 << 18
MEMBERS = "path string, part string, place long, member string, at long, kind int, packed long, size long, locked boolean"


def _lines(spark: SparkSession, path: str, glob: str) -> DataFrame | None:
    """``path, part, length, block, m, bytes``: all archives directly in ``path``, in lines."""
    reader = spark.read.format("text").option("lineSep", "\n")
    files = load_direct(reader, path, glob)
    if files is None:
        return None
    return files.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("part"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("m"),
        F.col("value").cast("binary").alias("bytes"),
    )


def _in_order(lines: DataFrame) -> DataFrame:
    return lines.repartition("path").sortWithinPartitions("path", "block", "m")


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[bytes]]]:
    """Per archive its first row (without bytes), and its lines, breaks included. The lines must be
    used up, or closed, before the next archive."""
    rows = ((batch, i) for batch in batches for i in range(batch.num_rows))
    held: list = [next(rows, None)]

    def lines(path: str) -> Iterator[bytes]:
        while held[0] is not None:
            batch, i = held[0]
            if batch.column("path")[i].as_py() != path:
                return
            data = batch.column("bytes")[i].as_py()
            held[0] = next(rows, None)
            if data is not None:
                yield data + b"\n"

    while held[0] is not None:
        batch, i = held[0]
        first = {n: batch.column(n)[i].as_py() for n in batch.schema.names if n != "bytes"}
        own = lines(first["path"])
        yield first, own
        for _ in own:  # what was not asked for
            pass


def members(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame | None:
    """One row per member of every archive directly in ``path``, in the order of its directory
    (``place``); ``at`` is the offset of its header. None if there is no archive."""
    lines = _lines(spark, path, glob)
    if lines is None:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("path", pa.string()), ("part", pa.string()), ("place", pa.int64()), ("member", pa.string()), ("at", pa.int64()),
             ("kind", pa.int32()), ("packed", pa.int64()), ("size", pa.int64()), ("locked", pa.bool_())]
        )
        for first, own in _archives(batches):
            kept: deque[bytes] = deque()
            total = dropped = 0
            for line in own:
                kept.append(line)
                total += len(line)
                while total - len(kept[0]) >= END_BYTES:
                    total -= len(kept[0])
                    dropped += len(kept.popleft())
            # The last line's break may not be in the file.
            end = b"".join(kept)[: first["length"] - dropped]
            with zipfile.ZipFile(io.BytesIO(end)) as archive:
                infos = archive.infolist()
            rows = [
                (first["path"], first["part"], i, x.filename, x.header_offset + dropped, x.compress_type, x.compress_size,
                 x.file_size, bool(x.flag_bits & 1))
                for i, x in enumerate(infos)
            ]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)

    found = _in_order(lines).mapInArrow(run, MEMBERS)
    return materialize(found, "zip-members")


class _Inflated(io.RawIOBase):
    """A member's content, read from its archive's lines."""

    def __init__(self, lines: Iterator[bytes], at: int, kind: int, packed: int, locked: bool, name: str) -> None:
        makers = {0: None, 8: lambda: zlib.decompressobj(-15), 12: bz2.BZ2Decompressor}
        if locked or kind not in makers:
            raise NotImplementedError(f"{name}: {'encrypted' if locked else f'compression {kind}'}")
        self.lines, self.ready, self.out = lines, b"", b""
        self._skip(at)
        header = self._take(30)
        self._skip(int.from_bytes(header[26:28], "little") + int.from_bytes(header[28:30], "little"))
        self.left, self.tool = packed, makers[kind]() if makers[kind] else None

    def readable(self) -> bool:
        return True

    def _fill(self) -> bool:
        parts, size = [], 0
        while size < _READ:
            line = next(self.lines, None)
            if line is None:
                break
            parts.append(line)
            size += len(line)
        self.ready += b"".join(parts)
        return bool(parts)

    def _skip(self, n: int) -> None:
        while n > len(self.ready):
            n -= len(self.ready)
            self.ready = b""
            if not self._fill():
                raise zipfile.BadZipFile("the archive ends before its member")
        self.ready = self.ready[n:]

    def _take(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._fill():
                raise zipfile.BadZipFile("the archive ends within its member")
        taken, self.ready = self.ready[:n], self.ready[n:]
        return taken

    def readinto(self, buffer) -> int:
        while not self.out and self.left:
            if not self.ready and not self._fill():
                raise zipfile.BadZipFile("the archive ends within its member")
            packed = self._take(min(self.left, len(self.ready), _READ))
            self.left -= len(packed)
            self.out = self.tool.decompress(packed) if self.tool else packed
        n = min(len(buffer), len(self.out))
        buffer[:n] = self.out[:n]
        self.out = self.out[n:]
        return n


def read_members(
    spark: SparkSession,
    path: str,
    chosen: DataFrame,
    read: Callable[[str, io.BufferedIOBase], Iterator[pd.DataFrame]],
    schema: StructType,
    glob: str = "*.zip",
) -> DataFrame:
    """``read(part, stream)`` of one member per archive: ``chosen`` has rows of ``members``, at most one
    per archive. The frames ``read`` yields become rows."""
    lines = _lines(spark, path, glob)
    facts = ["at", "kind", "packed", "locked", "member"]
    nothing = [F.lit(None).cast(t).alias(c) for c, t in zip(facts, ("long", "int", "long", "boolean", "string"))]
    # A member's facts travel as a first row before its archive's lines.
    head = chosen.select(
        "path", "part", F.lit(0).cast("long").alias("length"), F.lit(-1).cast("long").alias("block"),
        F.lit(0).cast("long").alias("m"), F.lit(None).cast("binary").alias("bytes"), *facts,
    )
    rows = head.unionByName(lines.select("path", "part", "length", "block", "m", "bytes", *nothing))
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, own in _archives(batches):
            if first["member"] is None:
                continue
            stream = io.BufferedReader(_Inflated(own, *(first[c] for c in facts)), _READ)
            for frame in read(first["part"], stream):
                yield pa.RecordBatch.from_pandas(frame, schema=target, preserve_index=False)

    return _in_order(rows).mapInArrow(run, schema)
