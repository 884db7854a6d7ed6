"""Approximate nearest neighbours by cosine: multiprobe p-stable hashing.

1.  *Index.* Every valid vector, scaled to length 1, gets per table the ``hashes`` cell numbers
    ``floor((a.v + b) / width)`` with Gaussian ``a``: its bucket. Cells at either end are open, so a
    table has at most ``CELLS ** hashes`` buckets, whatever the data.
2.  *Probes.* If a neighbour of cosine ``c`` has projection ``c p + sqrt(1 - c^2) N(0, 1)`` given the
    query's ``p``, a bucket's chance to hold it is a product over the hashes. A query visits
    occupied buckets in falling order of that chance until it adds up to ``success``. For a first
    round ``c`` is fitted: the middle cosine of the k-th neighbour of ``FIT_QUERIES`` queries,
    searched exhaustively.
3.  *Reranking.* Buckets are split into blocks of bounded size and queries into parts, so no task
    holds a hot bucket whole. A task multiplies its block with its queries and returns the best k
    per query by the exact measure on the original vectors; these are merged over all tables.
4.  The k-th cosine a query has found is never above its true one. In a second round every query
    visits what this cosine, and those between it and 1, ask for beyond its first visits: so a query
    whose neighbours are farther than the middle one's is not left with too few buckets.
5.  A query that found fewer than k visits all buckets of one table.

Nothing is capped: every vector is indexed, and every vector of a visited bucket is compared.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part,
nor do rows without an id or of a length other than the commonest. Candidates with the query's id
are its own row. Rows that repeat an id and a vector are one candidate. Equal scores go to the
smaller id. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import erf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.session import materialize

TABLES = 2
HASHES = 4
WIDTH = 1.5
CELLS = 8
SUCCESS = 0.9
BLOCK_ROWS = 4096
FIT_QUERIES = 128
# From a query's k-th cosine up to 1: nearer neighbours lie in buckets of their own.
RISES = (0.0, 0.5, 0.9)
_SEED = 97
_TIE = 1e-9


def valid_vectors(table: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, v`` with ``v`` as doubles of the commonest length, each such row once."""
    v = F.col(vector).cast("array<double>")
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable &= F.exists(v, lambda x: x != 0)
    rows = table.where(F.col(vec_id).isNotNull() & F.coalesce(usable, F.lit(False)))
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (length.d if length else 0)).dropDuplicates(["vec_id", "v"])


def _matrix(vectors: pa.Array) -> np.ndarray:
    n = len(vectors)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first: squares of tiny or huge ones stay finite.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Projections:
    """The hash functions, equal in every task."""

    def __init__(self, dimension: int, tables: int, hashes: int, width: float, seed: int) -> None:
        draw = np.random.default_rng(seed)
        self.a = draw.normal(size=(tables, dimension, hashes))
        self.b = draw.uniform(0, width, size=(tables, hashes))
        self.width, self.hashes = width, hashes
        self.code = CELLS ** np.arange(hashes)

    def cells(self, unit: np.ndarray, t: int) -> np.ndarray:
        cell = np.floor((unit @ self.a[t] + self.b[t]) / self.width).astype(np.int64)
        return np.clip(cell + CELLS // 2, 0, CELLS - 1)

    def buckets(self, unit: np.ndarray, t: int) -> np.ndarray:
        return self.cells(unit, t) @ self.code

    def chances(self, unit: np.ndarray, t: int, cosine: np.ndarray) -> np.ndarray:
        """Per query and bucket, the chance that a neighbour of the query's cosine is in it."""
        spread = np.sqrt(np.maximum(1 - cosine * cosine, 1e-6))
        edges = (np.arange(1, CELLS) - CELLS // 2) * self.width
        middle = cosine[:, None] * (unit @ self.a[t])
        z = (edges[None, None, :] - self.b[t][None, :, None] - middle[:, :, None]) / spread[:, None, None]
        below = 0.5 * (1 + np.vectorize(erf)(z / 2**0.5)) if z.size else z
        low = np.concatenate((np.zeros((*z.shape[:2], 1)), below), axis=2)
        high = np.concatenate((below, np.ones((*z.shape[:2], 1))), axis=2)
        cell = high - low
        out = np.ones((len(unit), 1))
        for k in range(self.hashes):  # the last hash is the highest digit of a bucket's number
            out = (cell[:, k, :, None] * out[:, None, :]).reshape(len(unit), -1)
        return out


def likeliest(chance: np.ndarray, success: float) -> np.ndarray:
    """The buckets of each row, in falling order of chance, until these add up to ``success``."""
    order = np.argsort(-chance, axis=1, kind="stable")
    sums = np.cumsum(np.take_along_axis(chance, order, axis=1), axis=1)
    before = np.concatenate((np.zeros((len(chance), 1)), sums[:, :-1]), axis=1)
    taken = np.zeros(chance.shape, bool)
    np.put_along_axis(taken, order, before < success * np.minimum(sums[:, -1:], 1), axis=1)
    return taken


def exact_best(
    ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``query_id, vec_id, score`` of every query's best k ids, ties to the smaller id. An id with
    several vectors counts by its best."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(ids) and len(query_ids):
        near = _unit(q) @ _unit(x).T
        near[query_ids[:, None] == ids[None, :]] = -np.inf
        by_id = np.argsort(ids, kind="stable")
        starts = np.flatnonzero(np.diff(ids[by_id], prepend=ids[by_id[0]] - 1))
        single = len(starts) == len(ids)
        for i, row in enumerate(near):
            each = row if single else np.maximum.reduceat(row[by_id], starts)
            usable = int(np.isfinite(each).sum())
            if not usable:
                continue
            least = -np.partition(-each, min(k, usable) - 1)[min(k, usable) - 1] - _TIE
            some = np.flatnonzero(row >= least)
            # Sums in one order for every pair, so equal vectors get equal scores.
            score = cosine(q[i], x[some])
            order = np.lexsort((ids[some], -score))
            _, first = np.unique(ids[some][order], return_index=True)
            order = order[np.sort(first)][:k]
            found.append((np.full(len(order), query_ids[i]), ids[some][order], score[order]))
    if not found:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*found))


def cosine(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    one = one / np.abs(one).max()
    many = many / np.abs(many).max(axis=1, keepdims=True)
    dots = (many * one).sum(axis=1)
    return dots / np.sqrt((one * one).sum()) / np.sqrt((many * many).sum(axis=1))


def _result(found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[pa.Array]:
    return [pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2])]


_NAMES = ["query_id", "vec_id", "score"]
_SCHEMA = "query_id long, vec_id long, score double"


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The best k of all found, as ``query_id, rank, vec_id, score``."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def fitted_cosine(rows: DataFrame, is_query: Column, k: int, fit_queries: int) -> float:
    """The middle cosine between a query and its k-th neighbour, from a bounded sample of queries
    compared with all rows."""
    sample = rows.where(is_query).orderBy(F.xxhash64("vec_id"), "vec_id").limit(fit_queries).collect()
    if not sample:
        return 0.5
    ids, q = np.array([r.vec_id for r in sample]), np.array([r.v for r in sample])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for low in range(0, len(own), BLOCK_ROWS):
                part = slice(low, low + BLOCK_ROWS)
                found = exact_best(own[part], x[part], ids, q, k)
                yield pa.RecordBatch.from_arrays(_result(found), _NAMES)

    kth = ranked(rows.mapInArrow(run, _SCHEMA), k).groupBy("query_id").agg(F.min("score").alias("s"))
    middle = kth.agg(F.percentile("s", 0.5)).first()[0]
    return float(min(max(middle if middle is not None else 0.5, 0.05), 0.999))


def nearest(
    table: DataFrame,
    is_query: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    tables: int = TABLES,
    hashes: int = HASHES,
    width: float = WIDTH,
    success: float = SUCCESS,
    block_rows: int = BLOCK_ROWS,
    fit_queries: int = FIT_QUERIES,
    seed: int = _SEED,
) -> DataFrame:
    """``query_id, rank, vec_id, score``; ``is_query`` is a condition on ``vec_id``."""
    rows = materialize(valid_vectors(table, vec_id, vector), "vectors")
    first = rows.select(F.size("v").alias("d")).first()
    functions = Projections(first.d if first else 1, tables, hashes, width, seed)
    mean = fitted_cosine(rows, is_query, k, fit_queries)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit(_matrix(batch.column(1)))
            for t in range(tables):
                buckets = pa.array(functions.buckets(unit, t), pa.int64())
                where = [pa.array(np.full(len(unit), t)), buckets]
                yield pa.RecordBatch.from_arrays(
                    [*where, *batch.columns], ["lsh", "bucket", "vec_id", "v"]
                )

    indexed = rows.mapInArrow(index, "lsh long, bucket long, vec_id long, v array<double>")
    indexed = materialize(indexed, "lsh-index")
    # At most tables * CELLS ** hashes rows, whatever the data.
    sizes = indexed.groupBy("lsh", "bucket").count().collect()
    blocks = {(r.lsh, r.bucket): -(-r["count"] // block_rows) for r in sizes}
    occupied = [np.array(sorted(b for u, b in blocks if u == t), np.int64) for t in range(tables)]
    queries = rows.where(is_query).select("vec_id", "v", F.lit(None).cast("double").alias("kth"))
    parts = max(1, -(-queries.count() // block_rows))

    def probes(everywhere: bool, again: bool):
        def visited(unit: np.ndarray, kth: np.ndarray, t: int) -> np.ndarray:
            def wanted(cosine: np.ndarray) -> np.ndarray:
                return likeliest(functions.chances(unit, t, cosine)[:, occupied[t]], success)

            if everywhere:
                return np.ones((len(unit), len(occupied[t])), bool)
            first = wanted(np.full(len(unit), mean))
            if not again:
                return first
            steps = [wanted(np.clip(kth + (1 - kth) * x, 0.05, 0.999)) for x in RISES]
            return np.logical_or.reduce(steps) & ~first

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, kth = _matrix(batch.column(1)), batch.column(2).to_numpy(zero_copy_only=False)
                for low in range(0, len(x), 256):
                    unit = _unit(x[low : low + 256])
                    for t in range(1 if everywhere else tables):
                        of, at = np.nonzero(visited(unit, kth[low : low + 256], t))
                        bucket = occupied[t][at]
                        count = np.array([blocks[t, b] for b in bucket.tolist()], np.int64)
                        of, bucket = np.repeat(of, count), np.repeat(bucket, count)
                        ends = np.cumsum(count)
                        block = np.arange(len(of)) - np.repeat(ends - count, count)
                        take = pa.array(of + low)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(of), t)),
                                pa.array(bucket),
                                pa.array(block),
                                batch.column(0).take(take),
                                batch.column(1).take(take),
                            ],
                            ["lsh", "bucket", "block", "query_id", "q"],
                        )

        return run

    def score(vectors: pa.Table, asked: pa.Table) -> pa.Table:
        x, q = vectors.combine_chunks(), asked.combine_chunks()
        found = exact_best(
            x.column("vec_id").to_numpy(),
            _matrix(x.column("v").combine_chunks()),
            q.column("query_id").to_numpy(),
            _matrix(q.column("q").combine_chunks()),
            k,
        )
        return pa.table(_result(found), names=_NAMES)

    spark = table.sparkSession
    shape = [(t, b, n) for (t, b), n in blocks.items()] or [(0, 0, 1)]
    shapes = spark.createDataFrame(shape, "lsh long, bucket long, blocks long")
    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).alias("block")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part")
    keys = ["lsh", "bucket", "block", "part"]

    def search(asked: DataFrame, everywhere: bool = False, again: bool = False) -> DataFrame:
        schema = "lsh long, bucket long, block long, query_id long, q array<double>"
        part = F.pmod(F.xxhash64("query_id"), F.lit(parts)).alias("part")
        visits = asked.mapInArrow(probes(everywhere, again), schema).select(*keys[:3], part, "query_id", "q")
        entries = indexed.join(shapes, ["lsh", "bucket"]).select(*keys[:2], block, "vec_id", "v")
        entries = entries.select(*keys[:3], each, "vec_id", "v")
        pairs = entries.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(score, _SCHEMA)
        return ranked(pairs, k)

    once = materialize(search(queries), "lsh-found")
    of = once.groupBy("query_id").agg(F.count("*").alias("count"), F.min("score").alias("kth"))
    of = of.where(F.col("count") >= k).select(F.col("query_id").alias("vec_id"), "kth")
    # The middle cosine is no query's own: each goes on with what it has found.
    more = search(queries.drop("kth").join(of, "vec_id"), again=True)
    best = once.select("query_id", "vec_id", "score").unionByName(more.drop("rank"))
    best = materialize(ranked(best, k), "lsh-found-again")
    short = materialize(queries.join(of.select("vec_id"), "vec_id", "left_anti"), "lsh-short")
    if short.isEmpty():
        return best
    everywhere = search(short, everywhere=True)
    return best.join(short.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(everywhere)
