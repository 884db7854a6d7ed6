"""Removal of every byte in a 400-byte string that also starts somewhere else in the corpus.

The collection is never sorted whole. Two facts keep every round small:

*   Among the hashes of the 64-byte strings in a 400-byte window, the leftmost smallest is its
    anchor. Equal windows have equal anchors at equal offsets. So a run of windows with one anchor
    is a *piece* (at most 337 windows, 736 bytes), pieces can only share windows if their anchors'
    hashes are equal, and then only in the alignment of the anchors.
*   Equal pieces are one class. If a class occurs twice, all its windows do.

What is left, classes of one anchor that differ, is sorted column-wise: aligned on their anchors,
all documents of a batch get one more symbol each round, from the right end to the left. A round is
the last-to-first step of the Burrows-Wheeler transform on the newest suffix of every document (a
stable sort by the new symbol), and the common prefixes follow as one plus the least of the old ones
between neighbours with the same symbol. A window is repeated where its common prefix with a
neighbour reaches 400. Older suffixes have another distance from the anchor, so they cannot share a
window and are dropped from the order; that is the difference from the construction for free
suffixes, and why memory is a batch of bounded size and needs no external files.

An anchor with more than ``crowd`` different classes does not fit a batch; its windows are counted
by their hashes instead, which Spark does with partial aggregates.

A task emits a text at most twice, however many copies it holds, and a piece that repeats within a
text once. Defined results: null text is empty; texts under 400 bytes stay whole; matches overlap;
they never cross texts; rows that repeat a text are each judged against the other, so such a text
of 400 bytes or more goes entirely. Null ids are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.words import Hasher, Rolling, pieces
from ledgerloom.session import materialize

LENGTH = 400
ANCHOR_BYTES = 64
BATCH_STRINGS = 8192
CROWD = 20_000
_STEP = 1 << 20
_PLACE_BITS = 21


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by prefix and suffix minima of blocks."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def cut_pieces(
    data: np.ndarray, offsets: np.ndarray, hasher: Hasher, rolling: Rolling, length: int, anchor: int
) -> tuple[np.ndarray, ...]:
    """``start, n, offset, value, content`` of all pieces: the first window's byte, the number of
    windows, the anchor's distance from the start, and the hashes of anchor and piece."""
    width = length - anchor + 1
    out = []
    for low in range(0, max(0, len(data) - length + 1), _STEP):
        part = data[low : low + _STEP + length - 1]
        n = len(part)
        # The windows that begin in this step and end in the text in which they begin.
        starts = np.arange(n - length + 1)
        next_text = offsets[np.searchsorted(offsets, starts + low, "right")]
        inside = starts + low + length <= next_text
        if not inside.any():
            continue
        # Unequal anchors with one hash are only compared in vain.
        hashes = rolling.strings(part, anchor)
        # The place in the low bits makes the least the leftmost of equal hashes.
        mask = np.uint64((1 << _PLACE_BITS) - 1)
        packed = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
        at = (_sliding_least(packed, width) & mask).astype(np.int64)[: len(starts)]
        starts, at = starts[inside], at[inside]
        begins = np.flatnonzero(
            np.concatenate(([True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)))
        )
        count = np.diff(np.concatenate((begins, [len(starts)])))
        first, place = starts[begins], at[begins]
        end = first + count + length - 1
        content = hasher.spans(hasher.prefix_sums(part), first, end)
        out.append((first + low, count, place - first, hashes[place], content))
    if not out:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, nothing.astype(np.uint64), nothing.astype(np.uint64)
    return tuple(np.concatenate(c) for c in zip(*out))


def repeated_windows(
    strings: list[np.ndarray], group: np.ndarray, offset: np.ndarray, n: np.ndarray, length: int
) -> list[np.ndarray]:
    """Per string, which of its ``n`` windows equal a window of another string of its group, all
    aligned at ``offset``. Strings of a group are neighbours."""
    m = len(strings)
    sizes = np.array([len(s) for s in strings])
    left, right = int(offset.max()), int((sizes - offset).max())
    columns = np.zeros((left + right, m), np.uint16)  # 0: no symbol here
    for i, s in enumerate(strings):
        low = left - int(offset[i])
        columns[low : low + len(s), i] = s.astype(np.uint16) + 1
    flags = np.zeros((left + right, m), bool)
    order = np.arange(m)
    common = np.zeros(m + 2, np.int32)  # with the one before; the ends stay 0
    rank = group.astype(np.int64) * 257
    for x in range(left + right - 1, -1, -1):
        symbol = columns[x][order]
        key = rank[order] + symbol
        step = np.argsort(key, kind="stable")
        key, symbol = key[step], symbol[step]
        alike = np.flatnonzero((key[1:] == key[:-1]) & (symbol[1:] > 0)) + 1
        fresh = np.zeros(m + 2, np.int32)
        if len(alike):
            bounds = np.column_stack((step[alike - 1] + 1, step[alike] + 1)).ravel()
            least = np.minimum.reduceat(common, bounds)[::2]
            fresh[alike] = np.minimum(least, length) + 1
        order, common = order[step], fresh
        hit = np.maximum(common[:m], common[1 : m + 1]) >= length
        flags[x, order[hit]] = True
    out = []
    for i in range(m):
        low = left - int(offset[i])
        out.append(flags[low : low + int(n[i]), i])
    return out


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of every run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return edges[::2], edges[1::2] - 1


def _int(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, pa.int64())


_PIECES = "doc_id long, k long, size long, start long, n long, offset long, value long, content long, times long"


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(content).alias("k"),
        F.octet_length(content).cast("long").alias("size"),
        content.alias("text"),
    )


def text_pieces(rows: DataFrame, length: int, anchor: int) -> DataFrame:
    """Pieces of the texts, as ``_PIECES``. ``value`` is null for windows already known to repeat
    within their text; ``times`` is 2 for a class that stands for such."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, rolling, seen = Hasher(), Rolling(), {}
        names = [c.split()[0] for c in _PIECES.split(", ")]
        for batch in batches:
            keys = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            for piece in pieces(batch.column(3)):
                wanted = np.zeros(piece.end - piece.begin, bool)
                for i in range(piece.begin, piece.end):
                    times = seen[keys[i]] = seen.get(keys[i], 0) + 1
                    wanted[i - piece.begin] = times <= 2
                found = cut_pieces(piece.data, piece.offsets, hasher, rolling, length, anchor)
                start, n, offset, value, content = found
                text = np.searchsorted(piece.offsets, start, "right") - 1
                keep = wanted[text]
                start, n, offset, value, content, text = (
                    c[keep] for c in (start, n, offset, value, content, text)
                )
                if not len(start):
                    continue
                order = np.lexsort((start, content, value, text))
                same = np.zeros(len(order), bool)
                a, b = order[1:], order[:-1]
                same[1:] = (text[a] == text[b]) & (value[a] == value[b]) & (content[a] == content[b])
                later = np.zeros(len(order), bool)
                later[order] = same
                doubled = np.zeros(len(order), bool)
                doubled[order[:-1]] = same[1:] & ~same[:-1]
                # Later pieces of a class: only where they are, as runs.
                rest = np.flatnonzero(later)
                run_at = np.flatnonzero(
                    np.concatenate(
                        (
                            [True] * bool(len(rest)),
                            (start[rest[1:]] != start[rest[:-1]] + n[rest[:-1]])
                            | (text[rest[1:]] != text[rest[:-1]]),
                        )
                    )
                )
                first = rest[run_at]
                last = rest[np.concatenate((run_at[1:], [len(rest)])) - 1] if len(rest) else rest
                here = np.concatenate((np.flatnonzero(~later), first))
                count = np.concatenate((n[~later], start[last] + n[last] - start[first]))
                is_run = np.arange(len(here)) >= len(here) - len(first)
                blank = pa.array(is_run)
                take = pa.array(text[here] + piece.begin)
                local = start[here] - piece.offsets[text[here]]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(take) for c in range(3)),
                        _int(local),
                        _int(count),
                        _int(offset[here]),
                        pa.array(value[here].view(np.int64), pa.int64(), mask=is_run),
                        _int(content[here]),
                        _int(np.where(doubled[here] & ~is_run, 2, 1)),
                    ],
                    names,
                )

    return rows.mapInArrow(run, _PIECES)


def _strings(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``value, content, offset, n, string`` of the wanted pieces, cut from their texts."""
    per_text = wanted.groupBy("doc_id", "k", "size").agg(
        F.collect_list(F.struct("start", "n", "offset", "value", "content")).alias("cuts")
    )
    per_text = per_text.select(F.col("doc_id").alias("of_id"), F.col("k").alias("of_k"), F.col("size").alias("of_size"), "cuts")
    same = F.col("doc_id").eqNullSafe(F.col("of_id"))
    same &= (F.col("k") == F.col("of_k")) & (F.col("size") == F.col("of_size"))
    joined = rows.join(per_text, same).select("text", "cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["value", "content", "offset", "n", "string"]
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for i in range(batch.num_rows):
                data = texts[i].as_py()
                cuts = batch.column(1)[i].values
                start, n = cuts.field("start").to_pylist(), cuts.field("n").to_pylist()
                cut = [data[a : a + k + length - 1] for a, k in zip(start, n)]
                fields = [cuts.field(c) for c in names[:4]]
                yield pa.RecordBatch.from_arrays([*fields, pa.array(cut, pa.binary())], names)

    return joined.mapInArrow(run, "value long, content long, offset long, n long, string binary")


def _column_wise(strings: DataFrame, length: int, batch_strings: int) -> DataFrame:
    """``value, content, low, high``: ranges of repeated windows, by the column-wise construction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, int, bytes]] = []

        def work(rows: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
            rows = list({r[:2]: r for r in rows}.values())
            value = np.array([r[0] for r in rows])
            group = np.cumsum(np.concatenate(([0], value[1:] != value[:-1])))
            offset, n = (np.array([r[i] for r in rows]) for i in (2, 3))
            texts = [np.frombuffer(r[4], np.uint8) for r in rows]
            out: list[tuple[int, int, int, int]] = []
            for r, flags in zip(rows, repeated_windows(texts, group, offset, n, length)):
                if flags.any():
                    out += [(r[0], r[1], int(a), int(b)) for a, b in zip(*_runs(flags))]
            columns = zip(*out) if out else [[]] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.int64()) for c in columns], ["value", "content", "low", "high"]
            )

        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns))
            if len(held) > batch_strings:
                # The last value's strings may go on in the next batch.
                cut = len(held)
                while cut and held[cut - 1][0] == held[-1][0]:
                    cut -= 1
                if cut:
                    yield work(held[:cut])
                    held = held[cut:]
        if held:
            yield work(held)

    ordered = strings.repartition("value").sortWithinPartitions("value")
    ordered = ordered.select("value", "content", "offset", "n", "string")
    return ordered.mapInArrow(run, "value long, content long, low long, high long")


def _by_hash(strings: DataFrame, length: int) -> DataFrame:
    """The same ranges for crowded anchors, by counting window hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for i in range(batch.num_rows):
                data = np.frombuffer(batch.column(4)[i].as_py(), np.uint8)
                n = len(data) - length + 1
                sums = hasher.prefix_sums(data)
                window = hasher.spans(sums, np.arange(n), np.arange(n) + length)
                fields = [pa.array(np.full(n, batch.column(c)[i].as_py())) for c in (0, 1, 2)]
                place = np.arange(n)
                yield pa.RecordBatch.from_arrays(
                    [*fields[:2], _int(place - batch.column(2)[i].as_py()), _int(place), _int(window)],
                    ["value", "content", "distance", "low", "window"],
                )

    schema = "value long, content long, distance long, low long, window long"
    windows = strings.select("value", "content", "offset", "n", "string").mapInArrow(run, schema)
    keys = ["value", "distance", "window"]
    often = windows.groupBy(*keys).count().where("count > 1").drop("count")
    return windows.join(often, keys, "left_semi").select("value", "content", "low", F.col("low").alias("high"))


def repeated_spans(
    rows: DataFrame, length: int, anchor: int, batch_strings: int, crowd: int
) -> DataFrame:
    """``k, size, spans``: byte ranges to remove, per text that has any."""
    found = materialize(text_pieces(rows, length, anchor), "pieces")
    known = found.where("value IS NOT NULL")
    keys = ["value", "content"]
    classes = known.groupBy(*keys).agg(F.sum("times").alias("times"))
    classes = materialize(classes, "piece-classes")
    kinds = classes.groupBy("value").agg(F.count("*").alias("kinds")).where("kinds > 1")
    kinds = materialize(kinds, "mixed-anchors")
    wanted = known.join(kinds, "value").dropDuplicates(keys)
    strings = materialize(_strings(rows, wanted, length).dropDuplicates(keys), "strings")
    crowded = kinds.where(F.col("kinds") > crowd).select("value")
    parts = _column_wise(strings.join(crowded, "value", "left_anti"), length, batch_strings)
    if not crowded.isEmpty():
        parts = parts.unionByName(_by_hash(strings.join(crowded, "value", "left_semi"), length))
    once = classes.where("times = 1").drop("times")
    parts = materialize(parts.join(once, keys, "left_semi"), "repeated-parts")
    full = classes.where("times > 1").drop("times")
    end = F.col("start") + F.col("n") + F.lit(length - 1)
    whole = known.join(full, keys, "left_semi").unionByName(found.where("value IS NULL"))
    ranges = whole.select("k", "size", F.col("start").alias("low"), end.alias("high")).unionByName(
        known.join(parts, keys).select(
            "k",
            "size",
            (F.col("start") + F.col("low")).alias("low"),
            (F.col("start") + F.col("high") + F.lit(length)).alias("high"),
        )
    )
    return (
        ranges.distinct()
        .groupBy("k", "size")
        .agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("spans"))
    )


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    anchor: int = ANCHOR_BYTES,
    batch_strings: int = BATCH_STRINGS,
    crowd: int = CROWD,
) -> DataFrame:
    """``doc_id, n_bytes, removed, kept`` per row: removed byte ranges as maximal runs
    (``low, high``, end exclusive), and the remaining bytes."""
    rows = _keyed(docs, doc_id, text)
    spans = materialize(repeated_spans(rows, length, anchor, batch_strings, crowd), "spans")
    joined = rows.join(spans, ["k", "size"], "left").select("doc_id", "size", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
        for batch in batches:
            texts, lists = batch.column(2).cast(pa.binary()), batch.column(3)
            kept, removed = [], []
            for i in range(batch.num_rows):
                data = texts[i].as_py()
                if not lists[i].is_valid:
                    kept.append(data)
                    removed.append([])
                    continue
                own = lists[i].values
                low, high = own.field("low").to_numpy(), own.field("high").to_numpy()
                high = np.maximum.accumulate(high)
                # A new run begins where a range begins after all before it have ended.
                first = np.flatnonzero(np.concatenate(([True], low[1:] > high[:-1])))
                low, high = low[first], high[np.concatenate((first[1:], [len(high)])) - 1]
                gone = list(zip(low.tolist(), high.tolist()))
                parts, at = [], 0
                for a, b in gone:
                    parts.append(data[at:a])
                    at = b
                parts.append(data[at:])
                kept.append(b"".join(parts))
                removed.append([{"low": a, "high": b} for a, b in gone])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(removed, kind), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "removed", "kept"],
            )

    schema = "doc_id long, n_bytes long, removed array<struct<low: long, high: long>>, kept binary"
    return joined.mapInArrow(run, schema)
