"""Mixing sources to target weights by balanced sampling with the cube method.

1.  A source's target is its weight's share of all words, at most ``most_repeats`` times its own
    words; the excess goes to the others by weight until none is above.
2.  With ``r = target / source words`` every document of a source is taken ``floor(r)`` times in
    full, and once more with inclusion probability ``r - floor(r)``.
3.  Flight: in a block of a source's documents, three undecided ones at a time move along the
    null-space of the two constraints (word total, document total) until one of them is 0 or 1, so
    a block keeps both totals and at most two of its documents stay undecided.
4.  The undecided ones of all blocks form new blocks, far fewer each time, until a source fits one
    block. There a dozen documents wait for the landing: of all ways to decide them and the last
    undecided two, the one nearest to the word total is taken, within one of the document total.

Blocks have a bounded expected size however large the source, so a hot source is many blocks. All
choices come from hashes of id, size and seed: reruns agree, on any partitioning.

Defined results: null text has size 0, as has a text without words. A null source is a source of
its own, after all others. Where all sizes are 0 all targets and takes are 0. Rows that repeat an
id are documents of their own. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.operators.index import dense_index
from ledgerloom.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3
BLOCK_ROWS = 1000
LANDING_ROWS = 12
LEVEL_CUTS = 64
_SEED = 7
_NEAR = 1e-9


def word_count(text: Column) -> Column:
    found = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return F.coalesce(found, F.lit(0).cast("long"))


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most_repeats: float = MOST_REPEATS,
) -> DataFrame:
    """``source, source_rows, source_size, target``, one row per source.

    Sorting and sharing see one row per source, never the documents, and neither puts all sources in
    one task. The number of rounds grows with the logarithm of the number of sources.
    """
    sources = materialize(
        sizes.groupBy("source").agg(
            F.count("*").alias("source_rows"), F.sum("size").alias("source_size")
        ),
        "sources",
    )
    numbered = dense_index(sources.withColumn("unnamed", F.isnull("source")), ["unnamed", "source"], "place")
    place = (F.col("place") % len(weights)).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    cap = F.col("source_size") * F.lit(float(most_repeats))
    sources = materialize(
        numbered.select("source", "source_rows", "source_size", weight.alias("weight"), cap.alias("cap")),
        "source-weights",
    )
    level, full = _level_below(sources), 0
    while True:  # each round fixes at least one more source at its cap
        above = F.col("cap") <= F.col("weight") * F.lit(level) if level else F.lit(False)
        now = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(above, F.col("cap")).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.count_if(above).alias("full"),
        ).first()
        if not now["all"] or not now["open"] or (level and now["full"] == full):
            break
        level, full = (now["all"] - now["fixed"]) / now["open"], now["full"]
    target = F.least(F.col("cap"), F.col("weight") * F.lit(level))
    return sources.select("source", "source_rows", "source_size", target.alias("target"))


def _level_below(sources: DataFrame) -> float:
    """The largest level, of those at which a source meets its cap, that does not share out more than
    all words; 0 if there is none."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    ratio = F.col("cap") / F.col("weight")
    low, high = 0.0, float("inf")
    while True:  # leaves about one of ``LEVEL_CUTS`` levels each time
        between = sources.where((ratio > low) & (ratio < high))
        cuts = between.agg(
            F.percentile_approx(ratio, [(i + 0.5) / LEVEL_CUTS for i in range(LEVEL_CUTS)])
        ).first()[0]
        if not cuts:
            return low
        cuts = sorted(set(cuts))
        shared = [F.sum(F.least(F.col("cap"), F.col("weight") * F.lit(c))) for c in cuts]
        sums = sources.agg(*[x.alias(f"s{i}") for i, x in enumerate(shared)]).first()
        low = max([low, *(c for c, x in zip(cuts, sums) if x <= total)])
        high = min([high, *(c for c, x in zip(cuts, sums) if x > total)])


def _draw(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def flight(size: list[float], chance: list[float], coin: list[float], land: bool) -> list[float]:
    """Moves inclusion probabilities to 0 or 1 with both totals kept; ``land`` decides all."""
    out = list(chance)
    held: list[int] = []

    def settle() -> None:
        held[:] = [i for i in held if _NEAR < out[i] < 1 - _NEAR]

    def move(direction: list[float], random: float) -> None:
        up = down = float("inf")
        for i, d in zip(held, direction):
            if d > 0:
                up, down = min(up, (1 - out[i]) / d), min(down, out[i] / d)
            elif d < 0:
                up, down = min(up, out[i] / -d), min(down, (1 - out[i]) / -d)
        # The choice keeps every probability's expectation.
        step = up if random * (up + down) < down else -down
        for i, d in zip(held, direction):
            x = out[i] + step * d
            out[i] = 0.0 if x < _NEAR else 1.0 if x > 1 - _NEAR else x
        settle()

    flown = max(0, len(size) - LANDING_ROWS) if land else len(size)
    for i in range(flown):
        held.append(i)
        settle()
        if len(held) == 3:
            a, b, c = (size[j] for j in held)
            direction = [b - c, c - a, a - b]  # orthogonal to the sizes and to the ones
            if not any(direction):
                direction = [1.0, -1.0, 0.0]
            move(direction, coin[i])
    if land:
        held += range(flown, len(size))
        settle()
        land_on_best(size, out, held)
    return out


def land_on_best(size: list[float], out: list[float], held: list[int]) -> None:
    """Decides the few held rows by the combination nearest to their expected word total, among
    those within one of their expected number; in place."""
    m = len(held)
    chosen = (np.arange(1 << m)[:, None] >> np.arange(m)) & 1
    sizes, chances = np.array([size[i] for i in held]), np.array([out[i] for i in held])
    number = np.abs(chosen.sum(axis=1) - chances.sum())
    words = np.abs(chosen @ sizes - chances @ sizes)
    best = np.lexsort((number, words, number > 1))[0] if m else 0
    for i, x in zip(held, chosen[best] if m else ()):
        out[i] = float(x)


def balanced_sample(rows: DataFrame, block_rows: int = BLOCK_ROWS, seed: int = _SEED) -> DataFrame:
    """``doc_id, copy, source, size, source_rows, chance`` with ``chance`` moved to 0 or 1.

    ``copy`` tells rows apart that repeat an id.
    """
    schema = "source string, source_rows long, doc_id long, copy long, size long, chance double"
    names = [c.split()[0] for c in schema.split(", ")]

    def decide(land: bool):
        def run(block: pa.Table) -> pa.Table:
            block = block.sort_by([(c, "ascending") for c in ("draw", "doc_id", "size", "copy")])
            columns = (block.column(c).to_pylist() for c in ("size", "chance", "coin"))
            moved = pa.array(flight(*columns, land), pa.float64())
            return block.select(names[:-1]).append_column("chance", moved)

        return run

    decided: list[DataFrame] = []
    level = 0
    while True:
        salt = F.lit(seed + level)
        blocks = F.greatest(F.ceil(F.col("source_rows") / F.lit(block_rows)), F.lit(1))
        block = F.pmod(F.xxhash64("doc_id", "copy", "size", salt), blocks)
        unit = [F.col("doc_id"), F.col("copy"), F.col("size"), salt]
        draws = [_draw(*unit, F.lit(i)).alias(c) for i, c in enumerate(("draw", "coin"))]
        drawn = rows.select(*names, block.alias("block"), *draws)
        last = rows.where(F.col("source_rows") > block_rows).isEmpty()
        moved = drawn.groupBy("source", "block").applyInArrow(decide(last), schema)
        moved = materialize(moved, "cube-flight")
        is_open = (F.col("chance") > _NEAR) & (F.col("chance") < 1 - _NEAR)
        if last:
            decided.append(moved)
            break
        decided.append(moved.where(~is_open))
        rest = moved.where(is_open)
        counts = rest.groupBy("source").agg(F.count("*").alias("source_rows"))
        same = F.col("source").eqNullSafe(F.col("of_source"))
        counts = counts.withColumnRenamed("source", "of_source")
        rows = rest.drop("source_rows").join(counts, same).drop("of_source")
        level += 1
    out = decided[0]
    for part in decided[1:]:
        out = out.unionByName(part)
    return out


def document_sizes(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """``doc_id, copy, source, size``; ``copy`` numbers rows that are alike in the others."""
    sizes = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        word_count(F.col(text)).alias("size"),
    )
    copies = Window.partitionBy("doc_id", "size", "source").orderBy(F.lit(0))
    return sizes.withColumn("copy", F.row_number().over(copies).cast("long"))


def mix_sources(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    most_repeats: float = MOST_REPEATS,
    block_rows: int = BLOCK_ROWS,
    seed: int = _SEED,
) -> DataFrame:
    """``doc_id, copy, source, size, source_size, target, repeats, taken`` per row of ``docs``."""
    sizes = materialize(document_sizes(docs, doc_id, text, source), "document-sizes")
    targets = materialize(source_targets(sizes, weights, most_repeats), "source-targets")
    targets = targets.withColumnRenamed("source", "of_source")
    same = F.col("source").eqNullSafe(F.col("of_source"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = sizes.join(targets, same).withColumn("ratio", ratio)
    whole = F.floor(F.col("ratio") + _NEAR)
    chance = F.greatest(F.col("ratio") - whole, F.lit(0.0)).alias("chance")
    chances = rows.select("source", "source_rows", "doc_id", "copy", "size", chance)
    sampled = balanced_sample(chances, block_rows, seed).drop("source_rows")
    repeats = (whole + F.round("chance")).cast("int")
    return (
        sampled.join(targets, same)
        .withColumn("ratio", ratio)
        .select(
            *("doc_id", "copy", "source", "size", "source_size", "target"),
            repeats.alias("repeats"),
            (F.col("size") * repeats).alias("taken"),
        )
    )


def mixed_documents(
    docs: DataFrame,
    repeats: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix_sources`` takes it; all columns as they were.

    A row's place in the mix is its id, source and size; rows alike in all three, null ids included,
    share out what the mix takes of them, copy by copy.
    """
    keys = ["_id", "_source", "_size"]
    taken = repeats.groupBy(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size")
    ).agg(F.count("*").alias("_alike"), F.max("repeats").alias("_repeats"), F.min("repeats").alias("_least"))
    # Alike rows are told apart only where the mix treats them differently.
    taken = materialize(taken.where("_repeats > 0"), "repeats")
    own = dict(zip(keys, (F.col(doc_id).cast("long"), F.col(source).cast("string"), word_count(F.col(text)))))
    named = docs.select("*", *[c.alias(k) for k, c in own.items()])

    def joined(times: DataFrame, rows: DataFrame, *more: str) -> DataFrame:
        other = times.select(*[F.col(k).alias(f"{k}_taken") for k in (*keys, *more)], "_repeats")
        same = F.lit(True)
        for k in (*keys, *more):
            same &= rows[k].eqNullSafe(other[f"{k}_taken"])
        each = F.explode(F.sequence(F.lit(1), F.col("_repeats"))).alias("_time")
        return rows.join(other, same).select(*[rows[f"`{c}`"] for c in docs.columns], each).drop("_time")

    alike = joined(taken.where("_least = _repeats"), named)
    mixed = taken.where("_least != _repeats")
    if mixed.isEmpty():
        return alike
    copies = Window.partitionBy(*keys).orderBy(F.lit(0))
    few = named.join(
        mixed.select(*[F.col(k).alias(f"{k}_mixed") for k in keys]),
        reduce(and_, (named[k].eqNullSafe(F.col(f"{k}_mixed")) for k in keys)),
        "left_semi",
    ).withColumn("_copy", F.row_number().over(copies).cast("long"))
    of_copy = repeats.where("repeats > 0").select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"),
        F.col("copy").alias("_copy"), F.col("repeats").alias("_repeats"),
    )
    return alike.unionByName(joined(of_copy, few, "_copy"))
