"""Line deduplication by pairwise alignment.

1.  Every document becomes its lines' hashes (white space at either end cut off; lines end at
    ``\\n``). A line of at least ``least_words`` words is telling.
2.  The first document that holds a telling line is its source. Every later holder is paired with
    it: one pair per document and source, so a line that a third of the corpus shares costs one
    pair per document, never pairs among the holders, and needs no limit on how common it is.
3.  A pair is aligned by patience diff: what matches at either end, then the longest rising sequence
    of the *rarest* lines, those that occur once on either side, and the gaps between them again.
4.  Aligned runs of lines that hold a telling line are deleted from the later document. All
    documents are aligned as they came, so the order of the work does not matter.
5.  With ``every_holder``, a telling line that is still there goes on to its other earlier holders,
    in rounds of 1, 2, 4, … holders, until it is aligned with one or none is left. Documents of
    equal lines count as one holder, and no pair is aligned twice. Only holders with which the line
    can be aligned at all are tried: those that share a key of ``partner_keys``. So a line that
    stands in many documents and is aligned in none of them pairs none of them.

Order is by id. Defined results: null text is empty; documents without telling lines stay whole.
Rows that repeat an id and a text are one document, and are treated alike; other texts of one id
are documents of their own, ordered by a hash. Rows without an id are left as they are and are no
source. A text that loses all its lines is empty.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.words import PRIME, Hasher, pieces, word_bounds
from ledgerloom.operators.index import dense_index
from ledgerloom.session import materialize

LEAST_WORDS = 5


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Index pairs of equal lines, rising in both, by patience diff."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        times_a, times_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {h: i for i, h in enumerate(a[a0:a1], a0) if times_a[h] == 1}
        shared = [(place[h], j) for j, h in enumerate(b[b0:b1], b0) if times_b[h] == 1 and h in place]
        if not shared:
            continue
        # The longest rising sequence of places in a: piles and back pointers.
        tops: list[int] = []
        at: list[int] = []
        back = [-1] * len(shared)
        for k, (i, _) in enumerate(shared):
            pile = bisect_left(tops, i)
            back[k] = at[pile - 1] if pile else -1
            tops[pile : pile + 1] = [i]
            at[pile : pile + 1] = [k]
        k, anchors = at[-1], []
        while k >= 0:
            anchors.append(shared[k])
            k = back[k]
        anchors.reverse()
        # Each gap begins at an anchor, which then matches at its start.
        edges = [(a0, b0), *anchors, (a1, b1)]
        todo += [(i, i2, j, j2) for (i, j), (i2, j2) in zip(edges, edges[1:])]
    return sorted(out)


def removed_lines(a: list[int], b: list[int], telling: list[bool]) -> list[int]:
    """Lines of ``b`` in aligned runs that hold a telling line."""
    out: list[int] = []
    run: list[int] = []
    before = (-2, -2)
    for i, j in [*aligned(a, b), (-1, -1)]:
        if (i, j) != (before[0] + 1, before[1] + 1):
            if any(telling[x] for x in run):
                out += run
            run = []
        run.append(j)
        before = (i, j)
    return out


# The sums over lines, and what makes one key of three of them.
_BASE, _LINE, _BEFORE, _AFTER = (3**33 % PRIME, 5**31 % PRIME, 7**29 % PRIME, 11**27 % PRIME)


def partner_keys(
    lines: list[int], telling: list[bool]
) -> tuple[list[int], list[int], list[tuple[int, int, int]]]:
    """``offers, asks, own`` of a document; ``own`` has ``h, start, end`` per telling line.

    Patience diff aligns a line ``h`` of two documents only if

    * ``h`` is in the run both begin with: then they agree up to their first ``h``, ``start``;
    * ``h`` is in the run both end with: then they agree from their last ``h`` on, ``end``;
    * or, with both runs cut off, some line stands once in either rest. Its other places are then in
      those runs, so the documents agree up to the place before and from the place after it: these
      and the line make the line's key. One of these keys is among the earlier document's ``offers``
      and the later one's ``asks``. Two first or two last lines are in the runs, so they are no match.
    """
    n = len(lines)
    values = [h % PRIME + 1 for h in lines]
    front, back, sums = [0] * n, [0] * n, 0
    for j in range(n):
        sums = front[j] = (sums * _BASE + values[j]) % PRIME
    sums = 0
    for j in reversed(range(n)):
        sums = back[j] = (sums * _BASE + values[j]) % PRIME
    after: dict[int, int] = {}
    rest = [0] * n
    for j in reversed(range(n)):
        rest[j] = after.get(lines[j], 0)
        after[lines[j]] = back[j]
    before: dict[int, int] = {}
    offers, asks, own = [], [], {}
    for j, h in enumerate(lines):
        key = (values[j] * _LINE + before.get(h, 0) * _BEFORE + rest[j] * _AFTER) % PRIME
        edge = 1 if j == 0 else 2 if j == n - 1 else 0
        offers.append(4 * key + edge)
        asks += [4 * key + other for other in (0, 1, 2) if other == 0 or other != edge]
        before[h] = front[j]
        if telling[j]:
            first, _ = own.get(h, (front[j], 0))
            own[h] = first, back[j]
    # The fourth remainder keeps these apart from the keys of lines.
    runs = [(h, x * _BEFORE % PRIME, y * _AFTER % PRIME) for h, (x, y) in own.items()]
    return offers, asks, [(h, 4 * x + 3, 4 * y + 3) for h, x, y in runs]


def document_lines(docs: DataFrame, doc_id: str, text: str, least_words: int) -> DataFrame:
    """``doc_id, k, hashes, telling`` per row with an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for piece in pieces(batch.column(2)):
                data, offsets = piece.data, piece.offsets
                starts, ends, _ = word_bounds(data, offsets)
                sums = hasher.prefix_sums(data)
                breaks = np.flatnonzero(data == 10)
                # A line begins at a text's start and after every break.
                begin = np.sort(np.concatenate((offsets[:-1], breaks + 1)))
                text_of = np.searchsorted(breaks, offsets)
                first = text_of + np.arange(len(offsets))
                end = np.empty(len(begin), np.int64)
                end[:-1], end[-1:] = begin[1:], offsets[-1]
                low, high = np.searchsorted(starts, begin), np.searchsorted(starts, end)
                hashes = np.zeros(len(begin), np.uint64)
                some = high > low
                left, right = starts[low[some]], ends[high[some] - 1]
                hashes[some] = hasher.spans(sums, left, right) | np.uint64(1)
                at = pa.array(first.astype(np.int32))
                ids = [c.slice(piece.begin, piece.end - piece.begin) for c in batch.columns[:2]]
                lists = [pa.array(hashes.view(np.int64)), pa.array(high - low >= least_words)]
                yield pa.RecordBatch.from_arrays(
                    [*ids, *(pa.ListArray.from_arrays(at, x) for x in lists)],
                    ["doc_id", "k", "hashes", "telling"],
                )

    rows = _keyed(docs, doc_id, text).where("doc_id IS NOT NULL")
    return rows.mapInArrow(run, "doc_id long, k long, hashes array<long>, telling array<boolean>")


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(content).alias("k"), content.alias("text")
    )


def _telling() -> Column:
    """The hashes of a row's telling lines."""
    return F.transform(
        F.filter(F.arrays_zip("hashes", "telling"), lambda x: x["telling"]), lambda x: x["hashes"]
    )


def _held(lines: DataFrame) -> DataFrame:
    """``doc, h``: the telling lines of every row of ``lines``."""
    return lines.select(
        F.struct("doc_id", "k").alias("doc"), F.explode(F.array_distinct(_telling())).alias("h")
    )


def first_holders(lines: DataFrame) -> DataFrame:
    """``h, source`` of the telling lines with several holders."""
    first = _held(lines).groupBy("h").agg(F.min("doc").alias("source"), F.count("*").alias("m"))
    return materialize(first.where("m > 1").drop("m"), "first-holders")


def document_pairs(lines: DataFrame, first: DataFrame) -> DataFrame:
    """``source, doc``: every document with the first holders of its telling lines."""
    later = _held(lines).join(first, "h").where(F.col("doc") > F.col("source"))
    # A written table on one side and an exchange above let Spark split a hot line in the join.
    return later.select("source", "doc").repartition("source", "doc").distinct()


def _aligned_pairs(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """``doc_id, k, gone``: line numbers to delete, per pair that has any."""
    one = lines.select(F.struct("doc_id", "k").alias("key"), "hashes", "telling").dropDuplicates(["key"])
    source = one.select(F.col("key").alias("source"), F.col("hashes").alias("a"))
    doc = one.select(F.col("key").alias("doc"), F.col("hashes").alias("b"), "telling")
    joined = pairs.join(source, "source").join(doc, "doc")
    joined = joined.select("doc.doc_id", "doc.k", "a", "b", "telling")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, telling = (batch.column(c).to_pylist() for c in (2, 3, 4))
            gone = [removed_lines(*x) for x in zip(a, b, telling)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(gone, pa.list_(pa.int32()))], ["doc_id", "k", "gone"]
            )

    found = joined.mapInArrow(run, "doc_id long, k long, gone array<int>")
    return found.where(F.size("gone") > 0)


def _left(lines: DataFrame, gone: DataFrame) -> DataFrame:
    """``doc, h``: the telling lines that stand in a document at a place not yet deleted."""
    of = gone.groupBy("doc_id", "k").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))
    kept = lines.join(of, ["doc_id", "k"], "left")
    stays = F.transform(
        F.col("telling"), lambda t, i: t & ~F.coalesce(F.array_contains("gone", i), F.lit(False))
    )
    return _held(kept.select("doc_id", "k", "hashes", stays.alias("telling")))


def _partner_keys(one: DataFrame) -> DataFrame:
    """``doc, offers, asks, own`` of every row of ``one``, see ``partner_keys``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [partner_keys(*x) for x in zip(*(batch.column(c).to_pylist() for c in (2, 3)))]
            own = [[{"h": h, "start": a, "end": b} for h, a, b in x[2]] for x in found]
            lists = pa.list_(pa.int64())
            struct = pa.list_(pa.struct([(c, pa.int64()) for c in ("h", "start", "end")]))
            keys = [pa.array([x[c] for x in found], lists) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *keys, pa.array(own, struct)], ["doc_id", "k", "offers", "asks", "own"]
            )

    keys = one.select("doc_id", "k", "hashes", "telling").mapInArrow(
        run,
        "doc_id long, k long, offers array<long>, asks array<long>,"
        " own array<struct<h: long, start: long, end: long>>",
    )
    return keys.select(F.struct("doc_id", "k").alias("doc"), "offers", "asks", "own")


def _possible_holders(one: DataFrame, left: DataFrame, holders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``held`` numbers the holders of every line and key, in order (``doc, at``). ``todo`` has, for
    each line left and each of its document's keys, the numbers ``start`` to ``stop`` to try."""
    holding = _held(one).join(left.select("h").distinct(), "h", "left_semi").join(holders, "doc", "left_semi")
    holding = materialize(holding.select("doc", "h"), "lines-held")
    asking = left.join(holders, "doc", "left_semi").select("doc", "h")
    keys = materialize(_partner_keys(one.join(holding.select("doc").distinct(), "doc", "left_semi")), "partner-keys")
    offers = keys.select("doc", F.explode("offers").alias("key"))
    asks = keys.join(asking.select("doc").distinct(), "doc", "left_semi").select("doc", F.explode("asks").alias("key"))
    # Most keys are one document's alone. They go before lines meet keys.
    shared = offers.groupBy("key").agg(F.min("doc").alias("low")).join(
        asks.groupBy("key").agg(F.max("doc").alias("high")), "key"
    )
    shared = materialize(shared.where("low < high"), "shared-keys")
    offers = offers.join(shared, "key").where("doc < high").select("doc", "key")
    asks = asks.join(shared, "key").where("doc > low").select("doc", "key")
    runs = keys.select("doc", F.explode("own").alias("x"))
    runs = runs.select("doc", "x.h", F.explode(F.array("x.start", "x.end")).alias("key"))
    asks = asks.join(asking, "doc").select("h", "key", "doc")
    asks = asks.unionByName(runs.join(asking, ["doc", "h"], "left_semi").select("h", "key", "doc"))
    asks = materialize(asks, "line-keys")
    offers = offers.join(holding, "doc").select("h", "key", "doc")
    offers = offers.unionByName(runs.join(holding, ["doc", "h"], "left_semi").select("h", "key", "doc"))
    last = asks.groupBy("h", "key").agg(F.max("doc").alias("high"))
    offers = offers.join(last, ["h", "key"]).where("doc <= high").select("h", "key", "doc")
    held = materialize(dense_index(offers, ["h", "key", "doc"], "at"), "line-holders")
    groups = held.groupBy("h", "key").agg(
        F.min("at").alias("start"), (F.max("at") + 1).alias("end"), F.min("doc").alias("low")
    )
    todo = asks.join(groups, ["h", "key"]).where("low < doc").join(held, ["h", "key", "doc"], "left")
    # A document that does not hold the key itself asks all holders; the later ones are left out.
    todo = todo.select("doc", "h", "start", F.coalesce("at", "end").alias("stop"))
    return held, materialize(todo.distinct(), "lines-to-pair")


def _other_holders(lines: DataFrame, first: DataFrame, pairs: DataFrame, gone: DataFrame) -> DataFrame:
    """What goes besides ``gone`` once every telling line left has met all its earlier holders."""
    left = _left(lines, gone).join(first, "h").where(F.col("doc") > F.col("source"))
    left = materialize(left.select("doc", "h").distinct(), "lines-left")
    if left.isEmpty():
        return gone
    one = lines.withColumn("doc", F.struct("doc_id", "k")).dropDuplicates(["doc"])
    content = F.struct(F.xxhash64("hashes"), F.xxhash64(F.reverse("hashes"), F.size("hashes")))
    # Where the first document of the same lines is not itself, that is aligned with all of it.
    same = one.select(content.alias("c"), "doc")
    same = same.join(same.groupBy("c").agg(F.min("doc").alias("source")), "c").select("source", "doc")
    same = materialize(same, "equal-lines")
    docs = left.select("doc").distinct()
    copies = same.where(F.col("doc") > F.col("source")).join(docs, "doc", "left_semi")
    of_copies = _aligned_pairs(copies.select("source", "doc"), lines)
    found = [gone, materialize(of_copies, "aligned-copies")]

    holders = same.where(F.col("doc") == F.col("source")).select("doc")
    held, todo = _possible_holders(one, left, holders)
    docs = todo.select("doc").distinct()
    open_lines = materialize(one.join(docs, "doc", "left_semi").select(*lines.columns), "open-lines")
    tried = materialize(pairs.join(docs, "doc", "left_semi").select("source", "doc"), "pairs-tried")
    low, step = 0, 1
    while not todo.isEmpty():
        until = F.least(F.col("start") + low + step, F.col("stop")) - 1
        asked = todo.select("doc", F.explode(F.sequence(F.col("start") + low, until)).alias("at"))
        source = held.select("at", F.col("doc").alias("source"))
        new = asked.join(source, "at").where(F.col("source") < F.col("doc")).select("source", "doc").distinct()
        new = materialize(new.join(tried, ["source", "doc"], "left_anti"), "more-pairs")
        found.append(materialize(_aligned_pairs(new, lines), "more-aligned-lines"))
        tried = tried.unionByName(new)
        low, step = low + step, 2 * step
        still = _left(open_lines, reduce(DataFrame.unionByName, found).join(
            open_lines.select("doc_id", "k"), ["doc_id", "k"], "left_semi"
        ))
        todo = todo.where(F.col("stop") > F.col("start") + low).join(still, ["doc", "h"], "left_semi")
        todo = materialize(todo, "lines-to-pair")
    return reduce(DataFrame.unionByName, found)


def remove_aligned_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_words: int = LEAST_WORDS,
    every_holder: bool = False,
) -> DataFrame:
    """``doc_id, n_lines, n_removed, kept`` per row; ``kept`` is the text of the other lines."""
    lines = materialize(document_lines(docs, doc_id, text, least_words), "document-lines")
    first = first_holders(lines)
    pairs = materialize(document_pairs(lines, first), "line-pairs")
    gone = materialize(_aligned_pairs(pairs, lines), "aligned-lines")
    if every_holder:
        gone = _other_holders(lines, first, pairs, gone)
    # A document's lines, at most once each however many sources they have.
    each = gone.select("doc_id", "k", F.explode("gone").alias("line")).distinct()
    of = each.groupBy("doc_id", "k").agg(F.collect_set("line").alias("gone"))
    rows = _keyed(docs, doc_id, text).join(of, ["doc_id", "k"], "left")
    numbered = F.split("text", "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(numbered) - 1), F.col("gone"))
    stays = F.transform(left, lambda i: F.element_at(F.col("lines"), i + 1))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(stays, "\n"))
    return rows.withColumn("lines", numbered).select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        kept.alias("kept"),
    )
