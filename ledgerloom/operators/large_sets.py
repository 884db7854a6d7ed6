"""All pairs of similar large word sets, by pairs of their rarer words; for texts, not for titles.

Single words of long texts are shared by too many texts by chance. Similar sets of sizes ``n`` and ``m`` share
``o`` words at least, so among the first ``n - o + 1 + c`` of either, in any fixed order, they share ``c + 1``
(Wang et al. 2012). Put in ``c`` classes by their hashes, two of these are in one class. So every set is found
under the pairs of first words of one class: about as many as it has words, and hardly any by chance. ``c``
follows from the smaller set's size, so a set may be found for two numbers of classes. Small sets are found under
single words.

1.  One pass gives sizes, 128-bit fingerprints, parity bits and a count sketch of fixed size, which orders words
    rare to common. Sets with one fingerprint are one set.
2.  Keys are packed by the tasks into blobs of a fixed number of buckets, and sets that meet are paired. Sizes and
    parity bits (a lower bound of the words two sets differ in) leave hardly more than the similar pairs.
3.  The words of records in such pairs are read again. Pairs with a record that no earlier one can be similar to are
    verified by them and drop the later ones, round by round; then all pairs that are left are verified.

Groups of many near copies would make a pair for any two of them: then there is no result, and the caller
proceeds by leaders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.text import non_blank, word_set
from ledgerloom.session import materialize

LARGE_SETS = 64  # mean size from which sets are paired here
SMALL_SET = 48
WORDS_A_CLASS = 6
SKETCH_BITS = 20
BUCKETS = 1 << 10
CROWDED = 10_000  # sets under one key
PAIRS_A_KEY = 250  # and key of a set, in one bucket; with more, there is no result
LEAST_PAIRS = 4_000_000
LAZY_ROUNDS = 6  # before all pairs that are left are verified
SCALE = 20  # steps of a set's size by a factor of e
_CHUNKS = 64
_EPS = 1e-9
_ENTRY = np.dtype([("key", "u1", 5), ("before", "u1", 5), ("node", "u1", 5), ("size", "u1")])
_NODE = (1 << 40) - 1
_U = np.uint64


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _sets_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Order and word hashes of every row."""
    lists = batch.column(1)
    values = _mix(lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64))
    ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    begin = 0
    for order, end in zip(batch.column(0).to_pylist(), ends.tolist()):
        yield order, values[begin:end]
        begin = end


def _fingerprint(words: np.ndarray) -> tuple[int, int]:
    spread = _mix(words ^ _U(0x9E3779B97F4A7C15))
    low = np.bitwise_xor.reduce(_mix(spread ^ _U(0x5851F42D4C957F2D)))
    return int(spread.sum(dtype=np.uint64).view(np.int64)), int(low.view(np.int64))


def _parity(words: np.ndarray) -> bytes:
    """Parity bits, one to two for each word; half of them folded on the others are those of half the width."""
    bits = min(max(256, 1 << (len(words) - 1).bit_length()), 1 << 16)
    count = np.bincount((words & _U(bits - 1)).view(np.int64), minlength=bits)
    return np.packbits((count & 1).astype(bool), bitorder="little").tobytes()


def _hashed(df: DataFrame, text: str, order: str) -> DataFrame:
    words = F.transform(word_set(F.col(text)), lambda w: F.xxhash64(w))
    return df.where(non_blank(F.col(text))).select(F.col(order).cast("long").alias("ord"), words.alias("words"))


def _signatures(hashed: DataFrame) -> tuple[DataFrame, np.ndarray]:
    names = ["ord", "n", "hi", "lo", "bits", "chunk", "counts"]
    schema = "ord long, n long, hi long, lo long, bits binary, chunk long, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            found = []
            for order, words in _sets_of(batch):
                found.append((order, len(words), *_fingerprint(words), _parity(words)))
            all_words = _mix(batch.column(1).flatten().to_numpy(zero_copy_only=False).view(np.uint64))
            cells += np.bincount((all_words >> _U(64 - SKETCH_BITS)).view(np.int64), minlength=len(cells))
            if found:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)]
                nothing = [pa.nulls(len(found), pa.int64()), pa.nulls(len(found), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns + nothing, names)
        if cells.any():
            parts = [x.tobytes() for x in np.split(cells.astype(np.uint32), _CHUNKS)]
            nothing = [pa.nulls(_CHUNKS, pa.int64())] * 4 + [pa.nulls(_CHUNKS, pa.binary())]
            yield pa.RecordBatch.from_arrays([*nothing, pa.array(range(_CHUNKS), pa.int64()), pa.array(parts)], names)

    def add(table: pa.Table) -> pa.Table:
        total = sum((np.frombuffer(x, np.uint32) for x in table.column("counts").to_pylist()), np.int64(0))
        return table.slice(0, 1).select(["chunk"]).append_column("counts", pa.array([total.astype(np.int64).tobytes()]))

    found = materialize(hashed.mapInArrow(run, schema), "set-signatures")
    chunks = found.where("chunk IS NOT NULL").select("chunk", "counts").groupBy("chunk")
    rows = {r.chunk: np.frombuffer(r.counts, np.int64) for r in chunks.applyInArrow(add, "chunk long, counts binary").collect()}
    size = (1 << SKETCH_BITS) // _CHUNKS
    sketch = np.concatenate([rows.get(i, np.zeros(size, np.int64)) for i in range(_CHUNKS)])
    return found.where("chunk IS NULL").select("ord", "n", "hi", "lo", "bits"), sketch


def classes_of(n: int) -> int:
    """Among how many classes a pair's first words are dealt, by the smaller one's size; 0: single words."""
    return 0 if n < SMALL_SET else 1 << (n // WORDS_A_CLASS).bit_length() - 1


def keys(ranked: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """What a set, rare words first, is found under, in an order that all sets have; and the key before
    each (0: none). Where two sets also share the key before, they meet there or still earlier."""
    n = len(ranked)
    first = n - max(int(np.floor(n * threshold - _EPS)), 0)
    most, least = classes_of(n), classes_of(max(int(np.ceil(n * threshold - _EPS)), 1))
    levels = {most, least} | {1 << i for i in range(30) if least <= 1 << i <= most and 1 << i >= classes_of(SMALL_SET)}
    out, before = [], []
    for c in levels:
        words = ranked[: first + c]
        if not c:
            out.append(_mix(words + _U(1)))
            before.append(np.concatenate((np.zeros(1, np.uint64), out[-1][:-1])))
            continue
        own = words % _U(c)
        order = np.argsort(own, kind="stable")
        words, own = words[order], own[order]
        step, pairs = 1, []
        while len(same := np.flatnonzero(own[step:] == own[:-step])):
            pairs.append((same, same + step))
            step += 1
        if pairs:
            x, y = (np.concatenate(side) for side in zip(*pairs))
            order = np.argsort(x, kind="stable")
            x, y = x[order], y[order]
            out.append(_mix(words[x] * _U(0x9E3779B97F4A7C15) + _mix(words[y] + _U(c))))
            before.append(np.concatenate((np.zeros(1, np.uint64), out[-1][:-1])))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(out), np.concatenate(before)


def _entries(hashed: DataFrame, sketch: np.ndarray, threshold: float) -> DataFrame:
    """``bucket, blob``: packed keys, nodes (40 bits of the fingerprint) and sizes on a scale of steps."""
    table = hashed.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = table.value, set()
        for batch in batches:
            found, earlier, nodes, sizes = [], [], [], []
            for _, words in _sets_of(batch):
                if not len(words) or (mark := _fingerprint(words)) in seen:
                    continue
                seen.add(mark)
                rare = counts[(words >> _U(64 - SKETCH_BITS)).view(np.int64)]
                own, before = keys(words[np.lexsort((words, rare))], threshold)
                found.append(own)
                earlier.append(before)
                nodes.append(np.full(len(own), mark[0] & _NODE, np.uint64))
                sizes.append(np.full(len(own), min(int(np.log(len(words)) * SCALE), 255), np.uint8))
            if not found:
                continue
            key, before, node, size = (np.concatenate(x) for x in (found, earlier, nodes, sizes))
            bucket = (key >> _U(40)).view(np.int64) & (BUCKETS - 1)
            order = np.argsort(bucket, kind="stable")
            packed = np.zeros(len(key), _ENTRY)
            packed["key"] = key[order].view(np.uint8).reshape(-1, 8)[:, :5]
            packed["before"] = before[order].view(np.uint8).reshape(-1, 8)[:, :5]
            packed["node"] = node[order].view(np.uint8).reshape(-1, 8)[:, :5]
            packed["size"] = size[order]
            ends = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
            here = np.flatnonzero(ends[1:] > ends[:-1])
            blobs = [packed[ends[i] : ends[i + 1]].tobytes() for i in here.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(here, pa.int64()), pa.array(blobs, pa.binary())], ["bucket", "blob"])

    return hashed.mapInArrow(run, "bucket long, blob binary")


def _met(near: int):
    """``a, b`` of a bucket; one row of nulls if there would be too many."""

    def run(table: pa.Table) -> pa.Table:
        rows = np.frombuffer(b"".join(table.column("blob").to_pylist()), _ENTRY)
        whole = np.zeros((len(rows), 8), np.uint8)
        whole[:, :5] = rows["key"]
        key = whole.view(np.uint64)[:, 0].copy()
        whole[:, :5] = rows["node"]
        node, size = whole.view(np.uint64)[:, 0].copy(), rows["size"].astype(np.int64)
        whole[:, :5] = rows["before"]
        before = whole.view(np.uint64)[:, 0]
        order = np.lexsort((node, size, key))
        key, before, node, size = key[order], before[order], node[order].view(np.int64), size[order]
        # Equal sets of different tasks are one.
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1]) | (size[1:] != size[:-1])))
        key, before, node, size = key[new], before[new], node[new], size[new]
        # By key and size, so that what a set can meet follows it.
        place = np.cumsum(np.concatenate(([0], key[1:] != key[:-1]))) * 1024 + size
        reach = np.searchsorted(place, place + near, "right") - np.arange(len(place)) - 1
        nothing = pa.table({"a": pa.array([None], pa.int64()), "b": pa.array([None], pa.int64())})
        if reach.max(initial=0) > CROWDED or reach.sum() > max(PAIRS_A_KEY * len(rows), LEAST_PAIRS):
            return nothing
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        ends, low = np.cumsum(reach), 0
        while low < len(reach):  # some million pairs at a time
            high = max(int(np.searchsorted(ends, (ends[low - 1] if low else 0) + LEAST_PAIRS, "right")), low + 1)
            own = reach[low:high]
            x = np.repeat(np.arange(low, high), own)
            y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(own) - own, own)
            first = (before[x] != before[y]) | (before[x] == 0)
            x, y = node[x[first]], node[y[first]]
            found.append((np.minimum(x, y), np.maximum(x, y)))
            low = high
        a, b = (np.concatenate(side) for side in zip(*found))
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))[: len(a)]
        return pa.table({"a": pa.array(a[new]), "b": pa.array(b[new])})

    return run


def _words_of(bits: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By width: the rows of so many words of parity bits, and these."""
    values, out = bits.to_pylist(), {}
    size = np.array([len(x) for x in values])
    for n in np.unique(size).tolist():
        rows = np.flatnonzero(size == n)
        out[n // 8] = rows, np.frombuffer(b"".join(values[i] for i in rows), np.uint64).reshape(-1, n // 8)
    return out


def _possible(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, m = (batch.column(c).to_numpy() for c in ("a_n", "b_n"))
            most = n + m - 2 * np.ceil((n + m) * (threshold / (1 + threshold)) - _EPS)
            most[np.minimum(n, m) < threshold * np.maximum(n, m) - _EPS] = -1
            fits = np.zeros(len(n), bool)
            sides = [_words_of(batch.column(c)) for c in ("a_bits", "b_bits")]
            for v, (x_rows, x) in sides[0].items():
                for w, (y_rows, y) in sides[1].items():
                    rows, i, j = np.intersect1d(x_rows, y_rows, assume_unique=True, return_indices=True)
                    if not len(rows):
                        continue
                    a, b = x[i], y[j]
                    while a.shape[1] != b.shape[1]:
                        if a.shape[1] < b.shape[1]:
                            a, b = b, a
                        half = a.shape[1] // 2
                        a = a[:, :half] ^ a[:, half:]
                    fits[rows] = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64) <= most[rows]
            yield batch.select(["a_ord", "b_ord"]).filter(pa.array(fits))

    return run


def possible_pairs(df: DataFrame, text: str, order: str, threshold: float) -> tuple[DataFrame, DataFrame] | None:
    """``ord`` of the first record of every set, and ``a, b`` (orders, a before b) of those that may be similar;
    nothing if sets are small, orders are not unique, or pairs would be too many."""
    hashed = _hashed(df, text, order)
    rows, sketch = _signatures(hashed)
    size = rows.agg(F.avg("n")).first()[0]
    if size is None or size < LARGE_SETS:
        return None
    if not rows.groupBy("ord").agg(F.count("*").alias("m")).where("m > 1 OR ord IS NULL").isEmpty():
        return None
    sets = rows.groupBy("n", "hi", "lo").agg(F.min("ord").alias("ord"), F.first("bits").alias("bits"))
    sets = materialize(sets.withColumn("node", F.col("hi").bitwiseAND(F.lit(_NODE))).drop("hi", "lo"), "distinct-sets")
    entries = _entries(hashed, sketch, threshold)
    near = int(np.ceil(np.log(1 / threshold) * SCALE)) + 1
    met = materialize(entries.groupBy("bucket").applyInArrow(_met(near), "a long, b long"), "met")
    if not met.where("a IS NULL").isEmpty():
        return None
    pairs = met.repartition("a").distinct()  # one exchange for this and the first join
    for side in ("a", "b"):
        of = sets.select(*[F.col(c).alias(f"{side}_{c}") for c in ("ord", "n", "bits")], F.col("node").alias(side))
        pairs = pairs.join(of, side).drop(side)
    possible = pairs.mapInArrow(_possible(threshold), "a_ord long, b_ord long").where("a_ord != b_ord")
    possible = possible.select(F.least("a_ord", "b_ord").alias("a"), F.greatest("a_ord", "b_ord").alias("b"))
    return sets.select("ord"), materialize(possible.distinct(), "possible-pairs")


def words_of(df: DataFrame, text: str, order: str, possible: DataFrame) -> DataFrame:
    """``ord, words`` of the records in pairs."""
    words = df.where(non_blank(F.col(text))).select(F.col(order).cast("long").alias("ord"), F.col(text).alias("text"))
    needed = possible.select(F.col("a").alias("ord")).union(possible.select("b")).distinct()
    held = words.join(needed, "ord", "left_semi").select("ord", word_set(F.col("text")).alias("words"))
    return materialize(held, "words-of-pairs")


def verified_pairs(possible: DataFrame, held: DataFrame, threshold: float) -> DataFrame:
    """Of the pairs those that are similar, by the words themselves, each first record with its partners."""
    needs = possible.select(F.col("a").alias("of"), F.col("b").alias("ord"))
    needs = needs.unionByName(possible.select(F.col("a").alias("of"), F.col("a").alias("ord")).distinct())

    def run(table: pa.Table) -> pa.Table:
        orders = table.column("ord").to_numpy()
        lists = table.column("words").combine_chunks()
        of = table.column("of")[0].as_py()
        codes = lists.flatten().dictionary_encode().indices.to_numpy()
        size = lists.value_lengths().to_numpy()
        row = np.repeat(np.arange(len(orders)), size)
        first = int(np.flatnonzero(orders == of)[0])
        own = np.zeros(codes.max(initial=0) + 1, bool)
        own[codes[row == first]] = True
        shared = np.bincount(row[own[codes]], minlength=len(orders))
        similar = shared / (size + size[first] - shared) > threshold
        similar[first] = False
        found = orders[similar]
        return pa.table({"a": pa.array(np.full(len(found), of), pa.int64()), "b": pa.array(found, pa.int64())})

    return materialize(needs.join(held, "ord").groupBy("of").applyInArrow(run, "a long, b long"), "similar-pairs")


def drop_by_heads(possible: DataFrame, held: DataFrame, threshold: float) -> tuple[list[DataFrame], DataFrame]:
    """Tables of dropped ``rid``, and the verified pairs among records still open.

    A record that no earlier one may be similar to is kept, and only pairs with kept records decide, so in
    a group of near copies a pair is verified for each record, not for any two."""
    dropped: list[DataFrame] = []
    for _ in range(LAZY_ROUNDS):
        if possible.isEmpty():
            return dropped, possible
        later = possible.select(F.col("b").alias("a")).distinct()
        heads = materialize(possible.select("a").distinct().join(later, "a", "left_anti"), "heads")
        drop = verified_pairs(possible.join(heads, "a", "left_semi"), held, threshold)
        drop = materialize(drop.select("b").distinct(), "dropped")
        dropped.append(drop.select(F.col("b").alias("rid")))
        gone = heads.union(drop.select("b"))
        possible = possible.join(gone, "a", "left_anti").join(drop, "b", "left_anti")
        possible = materialize(possible, "possible-pairs")
    return dropped, verified_pairs(possible, held, threshold)
