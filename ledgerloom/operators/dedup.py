"""Exact near-duplicate removal: a record stays if no earlier *kept* record is too similar.

Similarity is the Jaccard ratio of lower-cased word sets. The steps, each a join or an aggregate:

1.  Records with equal word sets are one set with the smallest order; copies can never stay.
2.  Words are ordered rare to common, by counts in a hash table of fixed size. Two sets above the threshold share a word among the first
    ``size - floor(threshold * size)`` of either (prefix filtering: Chaudhuri et al. 2006,
    Bayardo et al. 2007, Vernica et al. 2010), so candidates come from an equi-join on those.
3.  A word shared by a large part of the data would make that join quadratic. Only comparisons
    with *kept* records matter, so a round compares each record with the first ``k`` open records
    of each of its words (the leaders; all records of a word that few share). A record that leads for all its words knows every earlier
    neighbour and is compared with every later one, so it can be decided; what it drops is gone.
    A large group of near-copies therefore costs a few comparisons per record, not one per pair.
    ``k`` grows until the rest fits one unrestricted round. No pair is ever skipped for good.
4.  Words with at least ``hot`` holders come last in every set. Two sets that share none but such
    words share at least ``o`` of them, where ``o`` follows from the two sizes; so of the first
    ``hot words - o + l`` of either they share ``l`` (Wang et al. 2012). Sets without ``o`` hot words are
    out, and the others meet under ``l`` of their hot words at once, together with the two sizes. Dissimilar
    records that share a few hot words therefore never meet.
5.  Larger sets meet under several words of somewhat longer prefixes: where ``l - 1`` more of the first words
    are looked at, similar sets share ``l`` of them (Wang et al. 2012). Large sets that share a few rare words by
    chance are told apart by counting, when parity bits are too few for them.
    Pairs that meet are compared by sizes, place of the word, and parity bits of their sets, before any
    words are fetched: sets that differ in ``d`` bits differ in ``d`` words at least.
6.  Verified pairs are a small graph in record order; it is resolved by rounds of "no open earlier
    neighbour: keep; a kept earlier neighbour: drop". Paths of records with one earlier neighbour each
    are decided together, by pointer doubling: along them kept and dropped alternate.

Texts, whose sets are large, are paired at once by ``large_sets``, and 6. resolves what is left of the pairs; with
small sets, large groups of near copies or orders that are not unique, the steps above are taken.

Every round ends in a table in the shared checkpoint folder.
"""

from __future__ import annotations

import json
from functools import reduce
from math import comb

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions.text import non_blank, word_set
from ledgerloom.operators import large_sets
from ledgerloom.session import materialize

_EPS = 1e-9
ORDER_CELLS = 1 << 14
HOT_HOLDERS = 1000
SIGNED_WORDS = 128  # 128 parity bits say little about larger sets
SIGNATURE = 16  # longs of parity bits that decide before words are fetched
MOST_KEYS = 64  # of one set, under one partner size
WORDS_A_MEETING = 64  # a set of so many words more must share one word more to meet another
PLAIN_ROUNDS = 3  # before paths are looked for


def prefix_size(size: Column, threshold: float) -> Column:
    """How many of a set's rarest words must be looked at; never too few."""
    shared = F.greatest(F.floor(size * F.lit(threshold) - _EPS), F.lit(0))
    return (size - shared).cast("int")


def least_shared(x: Column, y: Column, threshold: float) -> Column:
    """How many words similar sets of these sizes share at least; never too many."""
    return F.ceil((x + y) * F.lit(threshold / (1 + threshold)) - F.lit(_EPS)).cast("int")


def _wide(x: Column, threshold: float) -> Column:
    """Whether sets of this size have partners for which hot words have too many combinations. These
    sets meet under single words, hot ones too."""
    if threshold < 0.5:  # partner sizes would be many, and sets would share few words
        return F.lit(True)
    largest = F.floor(x / threshold + _EPS).cast("int")
    return largest - least_shared(x, largest, threshold) > _most_excess(2)


def _meetings(x: Column, threshold: float) -> Column:
    """Of how many words in its prefix a set of this size must share with a similar one, if that one asks
    for as many and they share so many at all."""
    several = 1 + F.floor(x / WORDS_A_MEETING)
    return F.when(_wide(x, threshold), several).otherwise(F.lit(1)).cast("int")


def _parity(places: Column, words: int) -> Column:
    """``64 * words`` parity bits of a set as longs: a word turns over the bit at its place."""
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def long(k: Column) -> Column:
        turn = lambda p: F.call_function("shiftleft", one, p % 64)
        own = F.filter(places, lambda p: F.floor(p / 64) == k)
        return F.aggregate(own, none, lambda acc, p: acc.bitwiseXOR(turn(p)))

    return F.transform(F.sequence(F.lit(0), F.lit(words - 1)), long)


def _differing(a: Column, b: Column) -> Column:
    """In how many parity bits two sets differ; they differ in as many words at least."""
    bits = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda n, x: n + x)


def _too_different(sizes: Column, differ: Column, threshold: float) -> Column:
    t = F.lit(threshold)
    return F.coalesce((sizes - differ) * (t + 1.0) < t * 2.0 * sizes - _EPS, F.lit(False))


def word_sets(df: DataFrame, text: str, order: str, hot: int = HOT_HOLDERS) -> DataFrame:
    """``rid, ord, words, size, cold, sign, s0, s1`` per distinct non-empty word set, rare words first;
    ``cold`` of them have fewer than ``hot`` holders; ``sign`` are parity bits, ``s0`` and ``s1`` fewer of them
    for small sets."""
    # A test on the word set itself would be pushed down and build every set twice.
    sets = (
        df.where(non_blank(F.col(text)))
        .select(F.col(order).alias("ord"), F.sort_array(word_set(F.col(text))).alias("words"))
        .groupBy("words")
        .agg(F.min("ord").alias("ord"))
        .select(F.monotonically_increasing_id().alias("rid"), "ord", "words")
    )
    sets = materialize(sets, "sets")
    # Any fixed order of words is lossless, so counts by hash cell do: a table of fixed size, and
    # no word is shuffled to be counted or put back in its set.
    cell = lambda word: F.pmod(F.xxhash64(word), F.lit(ORDER_CELLS))
    counts = sets.select(F.explode("words").alias("word")).groupBy(cell("word").alias("cell"))
    numbers = [0] * ORDER_CELLS
    for row in counts.agg(F.count("*").alias("n")).collect():
        numbers[row.cell] = row.n
    # A constant, folded into an array when the plan is made.
    table = F.from_json(F.lit(json.dumps(numbers)), "array<bigint>")
    ranked = F.sort_array(
        F.transform(
            "words",
            lambda w: F.struct(F.element_at(table, cell(w).cast("int") + 1).alias("n"), w.alias("word")),
        )
    )
    ordered = sets.select("rid", "ord", ranked.alias("ranked")).select(
        "rid",
        "ord",
        F.transform("ranked", lambda r: r["word"]).alias("words"),
        F.size("ranked").alias("size"),
        F.size(F.filter("ranked", lambda r: r["n"] < hot)).alias("cold"),
    )
    bits = 64 * SIGNATURE
    ordered = ordered.withColumn("places", F.transform("words", lambda w: F.pmod(F.xxhash64(w), F.lit(bits)).cast("int")))
    few = F.transform("places", lambda p: p % 128)
    ordered = ordered.withColumn("sign", _parity(F.col("places"), SIGNATURE))
    ordered = ordered.withColumn("few", F.when(F.col("size") <= SIGNED_WORDS, _parity(few, 2)))
    ordered = ordered.select("*", *[F.col("few")[i].alias(f"s{i}") for i in (0, 1)]).drop("places", "few")
    return materialize(ordered, "ordered-sets")


def _combinations(words: Column, m: Column, width: int) -> Column:
    """``place, key`` of every ``width`` of the first ``m`` words; ``place`` is that of the first one."""
    places = F.sequence(F.lit(0), m - 1)
    rest = lambda i: F.slice(places, i + 2, m - 1 - i)  # the places after i

    def deeper(chosen: list[Column]) -> Column:
        if len(chosen) == width:
            key = F.concat_ws(" ", *[F.element_at(words, i + 1) for i in chosen])
            return F.array(F.struct(chosen[0].alias("place"), key.alias("key")))
        return F.flatten(F.transform(rest(chosen[-1]) if chosen else places, lambda i: deeper([*chosen, i])))

    return deeper([])


def _most_excess(width: int) -> int:
    """How many more than ``width`` words may be combined."""
    excess = 0
    while comb(excess + 1 + width, width) <= MOST_KEYS:
        excess += 1
    return excess


def _postings(sets: DataFrame, threshold: float) -> DataFrame:
    """``rid, ord, size, s0, s1, pos, word, meets``: similar sets meet under the ``word`` of one and what
    the other ``meets``. That is one word (then ``meets`` is null: the same) or, for hot words, several
    with the own and the partner's size, so that sets of one size never meet for the sake of another."""
    of = ["rid", "ord", "size", "s0", "s1"]
    looked_at = prefix_size(F.col("size"), threshold) + _meetings(F.col("size"), threshold) - 1
    prefix = F.slice("words", F.lit(1), looked_at)
    if threshold < 0.5:
        return sets.select(*of, F.posexplode(prefix).alias("pos", "word")).withColumn("meets", F.lit(None).cast("string"))
    x, y, hot = F.col("size"), F.col("y"), F.col("size") - F.col("cold")
    largest = F.floor(x / threshold + _EPS).cast("int")
    three, two = _most_excess(3), _most_excess(2)
    single = sets.select(*of, "cold", F.posexplode(prefix).alias("pos", "word"))
    single = single.where((F.col("pos") < F.col("cold")) | _wide(x, threshold)).drop("cold")
    single = single.withColumn("meets", F.lit(None).cast("string"))
    smallest = F.greatest(F.ceil(x * threshold - _EPS), F.lit(1)).cast("int")
    met = sets.where(hot >= least_shared(x, smallest, threshold)).select(
        *of, "cold", F.slice("words", F.col("cold") + 1, F.greatest(hot, F.lit(1))).alias("hot_words"),
        F.explode(F.sequence(smallest, largest)).alias("y"),
    )
    met = met.withColumn("o", least_shared(x, y, threshold)).withColumn("excess", F.greatest(x, y) - F.col("o"))
    # Sets that must share all their words, or one, would be equal.
    met = met.where((F.col("o") >= 2) & (hot >= F.col("o")) & (F.col("excess") <= two))
    width = F.when((F.col("excess") <= three) & (F.col("o") >= 3), F.lit(3)).otherwise(F.lit(2))
    met = met.withColumn("width", width).withColumn("m", hot - F.col("o") + F.col("width"))
    several = [
        met.where(F.col("width") == w).select(
            *of, "cold", "y", F.inline(_combinations(F.col("hot_words"), F.col("m"), w))
        )
        for w in (2, 3)
    ]
    combined = several[0].unionByName(several[1]).select(
        *of,
        (F.col("cold") + F.col("place")).alias("pos"),
        F.concat_ws(" ", x, y, "key").alias("word"),
        F.concat_ws(" ", y, x, "key").alias("meets"),
    )
    return single.unionByName(combined)


def _unrestricted(postings: DataFrame, fanout: int, max_group: int) -> bool:
    """Whether comparing all holders of each word stays within ``fanout`` pairs per posting, with
    no word held by more than ``max_group`` sets (its pairs meet in one task).

    Decided on word counts binned by power of two, a few dozen rows at most.
    """
    groups = postings.groupBy("word", "meets").agg(F.count("*").alias("m"))
    several = groups.where("meets IS NOT NULL")
    met = several.select(F.col("word").alias("meets"), F.col("m").alias("others"))
    several = several.join(met, "meets").select("m", "others")
    groups = groups.where("meets IS NULL").select("m", F.col("m").alias("others"))
    bins = (
        groups.unionByName(several)
        .groupBy(F.ceil(F.log2("m")).alias("bin"))
        .agg(
            F.sum("m").alias("postings"),
            F.sum(F.col("m").cast("double") * F.col("others")).alias("pairs"),
            F.max("m").alias("largest"),
        )
        .collect()
    )
    if any(b.largest > max_group for b in bins):
        return False
    return sum(b.pairs for b in bins) <= 2 * fanout * sum(b.postings for b in bins)


def _leaders(postings: DataFrame, k: int, small: int) -> tuple[DataFrame, DataFrame]:
    """The first ``k`` postings of each word, or all where a word has at most ``small``; and
    ``word, horizon``: where it has more, the order of the first one that does not lead.

    The rank limit is applied before the shuffle too, so a hot word sends few rows per task.
    """
    top = max(k, small)
    place = Window.partitionBy("word").orderBy("ord")
    ranked = postings.withColumn("rank", F.row_number().over(place))
    ranked = materialize(ranked.where(F.col("rank") <= top + 1), "leaders")
    rank = F.col("rank")
    if k >= small:
        leaders, first_late = ranked.where(rank <= k), ranked.where(rank == k + 1)
    else:
        hot = ranked.where(rank == small + 1).select("word")
        others = ranked.where((rank > k) & (rank <= small)).join(hot, "word", "left_anti")
        leaders = ranked.where(rank <= k).unionByName(others)
        first_late = ranked.where(rank == k + 1).join(hot, "word", "left_semi")
    return leaders.drop("rank"), first_late.select("word", F.col("ord").alias("horizon"))


def candidate_pairs(postings: DataFrame, leaders: DataFrame, threshold: float) -> DataFrame:
    """``a, b`` with ``a`` a leader before ``b``, that sizes, places, parity bits and the number of words they
    meet under cannot exclude. A pair of two waiting records may be left out, as not all of its words have
    ``a`` for a leader; it decides nothing in this round."""
    t = F.lit(threshold)
    a, b = leaders.alias("a"), postings.alias("b")
    sizes = F.col("a.size") + F.col("b.size")
    most_shared = F.least(F.col("a.size") - F.col("a.pos"), F.col("b.size") - F.col("b.pos"))
    asked = F.least(_meetings(F.col("a.size"), threshold), _meetings(F.col("b.size"), threshold))
    asked = F.greatest(F.least(asked, least_shared(F.col("a.size"), F.col("b.size"), threshold)), F.lit(1))
    differ = F.bit_count(F.col("a.s0").bitwiseXOR(F.col("b.s0")))
    differ = differ + F.bit_count(F.col("a.s1").bitwiseXOR(F.col("b.s1")))
    return (
        a.join(b, F.col("a.word") == F.coalesce("b.meets", "b.word"))
        .where(
            (F.col("a.ord") < F.col("b.ord"))
            & (
                F.least("a.size", "b.size") >= t * F.greatest("a.size", "b.size") - _EPS
            )
            # Holds for the first words the two share, if they are similar at all.
            & ((most_shared + asked - 1) * (t + 1.0) >= t * sizes - _EPS)
            & ~_too_different(sizes, differ, threshold)
        )
        .select(
            F.col("a.rid").alias("a"),
            F.col("b.rid").alias("b"),
            asked.alias("asked"),
            # Several words at once are enough.
            F.when(F.col("b.meets").isNull(), F.lit(1)).otherwise(asked).alias("met"),
        )
        .groupBy("a", "b")
        .agg(F.sum("met").alias("met"), F.first("asked").alias("asked"))
        .where("met >= asked")
        .select("a", "b")
    )


def similar_pairs(
    sets: DataFrame, postings: DataFrame, leaders: DataFrame, threshold: float
) -> DataFrame:
    """Verified pairs ``a, b, a_ord, b_ord`` with ``a`` a leader before ``b``."""
    candidates = candidate_pairs(postings, leaders, threshold)
    # Only parity bits are fetched for all of them, words for those these cannot exclude.
    for side in ("a", "b"):
        signs = sets.select(F.col("rid").alias(side), F.col("size").alias(f"{side}_size"), F.col("sign").alias(f"{side}_sign"))
        candidates = candidates.join(signs, side)
    differ = _differing(F.col("a_sign"), F.col("b_sign"))
    possible = candidates.where(~_too_different(F.col("a_size") + F.col("b_size"), differ, threshold))
    candidates = materialize(possible.select("a", "b"), "candidates")

    def fetched(side: str) -> DataFrame:
        # Words of sets in no pair are not moved.
        words = sets.select(F.col("rid").alias(side), F.col("ord").alias(f"{side}_ord"), F.col("words").alias(f"{side}_words"))
        return words.join(candidates.select(side).distinct(), side, "left_semi")

    shared = F.size(F.array_intersect("a_words", "b_words"))
    union = F.size("a_words") + F.size("b_words") - shared
    return (
        candidates.join(fetched("a"), "a")
        .join(fetched("b"), "b")
        .where(shared.cast("double") / union > F.lit(threshold))
        .select("a", "b", "a_ord", "b_ord")
    )


def _path_ends(edges: DataFrame, heads: DataFrame) -> DataFrame:
    """``node, odd``: records at the end of a path from a kept one along which every record has one
    earlier neighbour; ``odd`` is the parity of its length. Pointers double until they reach a path's
    top, so there are as many rounds as the longest path's length has binary digits."""
    single = edges.groupBy("b").agg(F.count("*").alias("n"), F.min("a").alias("up"), F.max("b_waits").alias("waits"))
    paths = single.where("n = 1 AND NOT waits").select(F.col("b").alias("node"), "up", F.lit(True).alias("odd"))
    paths = materialize(paths, "paths")
    while True:
        # A top has itself no pointer, so what has arrived stays as it is.
        next_up = paths.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("odd").alias("more"))
        moved = paths.join(next_up, "up", "left").select(
            "node",
            F.coalesce("next", "up").alias("up"),
            F.when(F.col("next").isNull(), F.col("odd")).otherwise(F.col("odd") != F.col("more")).alias("odd"),
            F.col("next").isNotNull().alias("moves"),
        )
        moved = materialize(moved, "paths")
        paths = moved.drop("moves")
        if moved.where("moves").isEmpty():
            return paths.join(heads.select(F.col("a").alias("up")), "up", "left_semi").select("node", "odd")


def resolve(edges: DataFrame, plain_rounds: int = PLAIN_ROUNDS) -> tuple[list[DataFrame], DataFrame]:
    """Tables of dropped ``rid`` and the ``rid`` still open after no edge can be decided.

    ``edges`` has ``a, b, a_ord, b_ord, a_waits, b_waits``; a waiting record may be dropped here
    but not kept.
    """
    dropped: list[DataFrame] = []
    while True:
        blocked = edges.select(F.col("b").alias("a")).distinct()
        heads = edges.where(~F.col("a_waits")).select("a").distinct().join(blocked, "a", "left_anti")
        if len(dropped) >= plain_rounds:
            heads = materialize(heads, "heads")
            ends = materialize(_path_ends(edges, heads), "path-ends")
            heads = heads.union(ends.where("NOT odd").select("node"))
        drop = materialize(edges.join(heads, "a", "left_semi").select("b").distinct(), "dropped")
        if drop.isEmpty():
            return dropped, edges.select(F.col("b").alias("rid")).distinct()
        dropped.append(drop.select(F.col("b").alias("rid")))
        edges = edges.join(drop, "b", "left_anti").join(
            drop.select(F.col("b").alias("a")), "a", "left_anti"
        )
        edges = materialize(edges, "edges")


def _kept_at_once(df: DataFrame, threshold: float, text: str, order: str) -> DataFrame | None:
    """The same for large sets without large groups of near copies: all similar pairs, resolved at once."""
    if threshold < 0.5 or dict(df.dtypes)[order] not in ("tinyint", "smallint", "int", "bigint"):
        return None
    found = large_sets.possible_pairs(df, text, order, threshold)
    if found is None:
        return None
    sets, possible = found
    held = large_sets.words_of(df, text, order, possible)
    by_heads, pairs = large_sets.drop_by_heads(possible, held, threshold)
    edges = pairs.select(
        "a", "b", F.col("a").alias("a_ord"), F.col("b").alias("b_ord"), F.lit(False).alias("a_waits"), F.lit(False).alias("b_waits")
    )
    dropped, _ = resolve(materialize(edges, "edges"))
    gone = [d.withColumnRenamed("rid", "ord") for d in by_heads + dropped]
    rest = reduce(lambda s, d: s.join(d, "ord", "left_anti"), gone, sets)
    return materialize(rest, "kept")


def kept_orders(
    df: DataFrame,
    threshold: float,
    text: str = "title",
    order: str = "ord",
    fanout: int = 32,
    first_leaders: int = 4,
    small_group: int = 32,
    max_group: int = 20_000,
    hot: int = HOT_HOLDERS,
) -> DataFrame:
    """``ord`` of the records with a non-empty word set that stay."""
    at_once = _kept_at_once(df, threshold, text, order)
    if at_once is not None:
        return at_once
    open_sets = word_sets(df, text, order, hot)
    kept: list[DataFrame] = []
    k = first_leaders
    while True:
        postings = materialize(_postings(open_sets, threshold), "postings")
        if _unrestricted(postings, fanout, max_group):
            leaders, waiting = postings, None
        else:
            leaders, horizon = _leaders(postings, k, small_group)
            # Not compared with all earlier records, or not with all later ones.
            under = postings.select("rid", "ord", "word").unionByName(
                postings.where("meets IS NOT NULL").select("rid", "ord", F.col("meets").alias("word"))
            )
            late = under.join(horizon, "word").where(F.col("ord") >= F.col("horizon"))
            waiting = materialize(late.select("rid").distinct(), "waiting")
        edges = similar_pairs(open_sets, postings, leaders, threshold)
        if waiting is None:
            edges = edges.withColumn("a_waits", F.lit(False)).withColumn("b_waits", F.lit(False))
        else:
            for side in ("a", "b"):
                flag = waiting.select(F.col("rid").alias(side), F.lit(True).alias(f"{side}_waits"))
                edges = edges.join(flag, side, "left").fillna(False, [f"{side}_waits"])
        dropped, still_open = resolve(materialize(edges, "edges"))
        rest = reduce(lambda s, d: s.join(d, "rid", "left_anti"), dropped, open_sets)
        undecided = still_open if waiting is None else still_open.union(waiting).distinct()
        kept.append(materialize(rest.join(undecided, "rid", "left_anti").select("ord"), "kept"))
        if waiting is None:
            break
        open_sets = materialize(rest.join(undecided, "rid", "left_semi"), "open-sets")
        if open_sets.isEmpty():
            break
        k *= 4
    return reduce(DataFrame.union, kept)


def duplicate_status(
    df: DataFrame, threshold: float = 0.8, text: str = "title", order: str = "ord", **tuning
) -> DataFrame:
    """``df`` with ``kept``: false where an earlier kept record's text is more similar than
    ``threshold``. ``order`` must be unique. Texts without words always stay."""
    if threshold < 0:
        raise ValueError("threshold must not be negative")
    if threshold >= 1:
        return df.withColumn("kept", F.lit(True))
    kept = kept_orders(df, threshold, text, order, **tuning)
    flag = kept.select(F.col("ord").alias(order), F.lit(True).alias("_kept"))
    marked = df.join(flag, order, "left")
    wordless = ~non_blank(F.col(text))
    return marked.withColumn("kept", F.coalesce("_kept", wordless)).drop("_kept")


def remove_near_duplicates(
    df: DataFrame, threshold: float = 0.8, text: str = "title", order: str = "ord", **tuning
) -> DataFrame:
    """The records that stay; arguments as for :func:`duplicate_status`."""
    return duplicate_status(df, threshold, text, order, **tuning).where("kept").drop("kept")


def dedup_counts(status: DataFrame) -> DataFrame:
    """Records before, after and removed."""
    return status.agg(
        F.count("*").alias("before"),
        F.count_if("kept").alias("after"),
        F.count_if(~F.col("kept")).alias("removed"),
    )
