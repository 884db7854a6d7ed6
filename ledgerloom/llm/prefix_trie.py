"""Prefix trie of rebuilt conversations, from fingerprints alone.

A rebuilt conversation is the head of its base conversation, then its own turns behind that head. It is
never written out: a turn's key (a digest of role and text) is an affine map modulo 2^61 - 1, maps
compose associatively, and the fingerprint of a rebuilt prefix is the product of the base's head and
the conversation's own suffix. What is stored are the input's turns, once, in order.

1.  Turns are sorted over the whole cluster and numbered. Only a base's first few turns are gathered.
2.  Products of own turns run in chunks of ``CHUNK`` turns, so a conversation that holds a third of all
    turns is spread over many tasks; a chunk's product is carried to the next ones.
3.  Equal (depth, fingerprint) is one node. Equality is verified, not believed: all members of a node
    must have one parent and one last key, and stored turns that share a key must have equal role and
    text. Should a check fail, everything is done again with other keys.
4.  A node belongs to its smallest member, so a conversation owns the lower end of its own path, and
    what lies below a node is what its members own, less what its owner owns above it. Hence the
    subtree sums need one join and one aggregate, however deep the trie is.
5.  The ids of a node's complete conversations are sorted over the cluster and joined to bounded
    texts; a digest reads these one after another, so a node with a third of all conversations costs
    one task a few thousandths of their number of rows.

Defined results: rows without a conversation id are left out. Null roles and texts are empty texts.
Turns of one conversation with equal numbers (null first) follow each other by role, then text;
repeated rows are turns of their own. A conversation whose head and suffix are empty is a member of
the root. An empty table has no nodes. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.operators.index import dense_index
from ledgerloom.session import materialize

PRIME = (1 << 61) - 1
CHUNK = 1024  # turns of one conversation that one task multiplies in a row
BLOCK = 4096  # conversation ids in one text
FAMILY = 100  # conversations that share a base
LONGEST_HEAD = 5
NODE = ["depth", "f1", "f2"]
MAPS = ["a1", "b1", "a2", "b2"]
KEYS = ["k1", "k2", "k3", "k4"]


def turn_keys(role: Column, text: Column, salt: int) -> list[Column]:
    """Four 60-bit numbers from a digest of role and text."""
    whole = F.concat(F.lit(f"{salt}:"), F.length(role).cast("string"), F.lit(":"), role, text)
    digest = F.sha2(whole, 256)
    return [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("long") for i in range(4)]


def base_of(conv_id: Column) -> Column:
    return conv_id - conv_id % FAMILY


def head_length(conv_id: Column) -> Column:
    """How many turns of the base a conversation begins with, if the base has so many."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % (LONGEST_HEAD + 1)).cast("int")


def _as_map(k: tuple[int, int, int, int]) -> tuple[int, int, int, int]:
    return k[0] % (PRIME - 1) + 1, k[1] % PRIME, k[2] % (PRIME - 1) + 1, k[3] % PRIME


def _then(f, g):
    """First ``f``, then ``g``."""
    return (
        g[0] * f[0] % PRIME,
        (g[0] * f[1] + g[1]) % PRIME,
        g[2] * f[2] % PRIME,
        (g[2] * f[3] + g[3]) % PRIME,
    )


ONE = (1, 0, 1, 0)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = np.array(rows, np.int64).reshape(len(rows), len(names)).T
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _running(names: list[str], out: list[str], start: Callable) -> Callable:
    """An Arrow function over sorted rows ``conv_id, chunk, ..., k1..k4, ...``: the product before and
    after each row. ``start(row)`` is the state before a chunk's first row."""
    key_at = [names.index(k) for k in KEYS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state = None, ONE
        for batch in batches:
            rows = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:2] != here:
                    here, state = row[:2], start(row)
                before = state
                state = _then(state, _as_map(tuple(row[i] for i in key_at)))
                rows.append((*row, *before, *state))
            if rows:
                yield _batch(rows, out)

    return run


_BEFORE = ["pa1", "pb1", "pa2", "pb2"]


def _products(rows: DataFrame, order: str, head: list[str] = []) -> DataFrame:
    """``rows`` (all longs) with the products before (``pa1..pb2``) and after (``a1..b2``) each row;
    they begin anew in every chunk, the first one at the map in the columns ``head``."""
    rows = rows.select("conv_id", "chunk", order, "n_chars", *KEYS, *head)
    names = rows.columns
    out = names + _BEFORE + MAPS
    at = [names.index(h) for h in head]

    def start(row: tuple) -> tuple:
        return tuple(row[i] for i in at) if at and row[1] == 0 else ONE

    dealt = rows.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", order)
    schema = ", ".join(f"{n} long" for n in out)
    return dealt.mapInArrow(_running(names, out, start), schema).drop(*head)


def _carry(own: DataFrame) -> DataFrame:
    """``own`` with products that run on from chunk to chunk."""
    last = F.max_by(F.struct(*MAPS), "depth")
    totals = own.groupBy("conv_id", "chunk").agg(last.alias("m")).select("conv_id", "chunk", "m.*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state = None, ONE
        for batch in batches:
            rows = []
            for conv_id, chunk, *m in zip(*(c.to_pylist() for c in batch.columns)):
                if conv_id != here:
                    here, state = conv_id, ONE
                rows.append((conv_id, chunk, *state))
                state = _then(state, m)
            if rows:
                yield _batch(rows, ["conv_id", "chunk", "ca1", "cb1", "ca2", "cb2"])

    dealt = totals.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    before = dealt.mapInArrow(run, "conv_id long, chunk long, ca1 long, cb1 long, ca2 long, cb2 long")
    carried = own.where("chunk > 0").join(before.where("chunk > 0"), ["conv_id", "chunk"])
    names = carried.columns
    at = {n: i for i, n in enumerate(names)}

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held, carry = list(row), tuple(row[at[c]] for c in ("ca1", "cb1", "ca2", "cb2"))
                for group in (_BEFORE, MAPS):
                    product = _then(carry, tuple(row[at[n]] for n in group))
                    for n, x in zip(group, product):
                        held[at[n]] = x
                rows.append(tuple(held))
            if rows:
                yield _batch(rows, names)

    run_on = carried.mapInArrow(compose, ", ".join(f"{n} long" for n in names))
    return own.where("chunk = 0").unionByName(run_on.select(own.columns))


def _stored(conversations: DataFrame, columns: dict[str, str], salt: int) -> DataFrame:
    """All turns in order, numbered, with their keys."""
    c = {k: F.col(v) for k, v in columns.items()}
    rows = conversations.where(c["conv_id"].isNotNull()).select(
        c["conv_id"].cast("long").alias("conv_id"),
        c["turn"].cast("long").alias("turn"),
        F.coalesce(c["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(c["text"].cast("string"), F.lit("")).alias("text"),
    )
    keys = turn_keys(F.col("role"), F.col("text"), salt)
    rows = rows.select(
        "*", F.length("text").cast("long").alias("n_chars"), *[k.alias(n) for k, n in zip(keys, KEYS)]
    )
    return dense_index(rows, ["conv_id", "turn", "role", "text"])


def _conversations(stored: DataFrame) -> DataFrame:
    """One row per conversation: where its turns begin, and the products of the head it starts with."""
    first = stored.groupBy("conv_id").agg(F.min("idx").alias("first"), F.count("*").alias("n"))
    first = materialize(first, "conversations")
    bases = stored.where(base_of(F.col("conv_id")) == F.col("conv_id")).join(first, "conv_id")
    bases = bases.withColumn("pos", F.col("idx") - F.col("first") + 1).where(F.col("pos") <= LONGEST_HEAD)
    heads = _products(bases.withColumn("chunk", F.lit(0).cast("long")), "pos")
    item = F.struct("pos", "n_chars", "k1", "k2", *_BEFORE, *MAPS)
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    rows = first.select(
        "*", base_of(F.col("conv_id")).alias("base"), head_length(F.col("conv_id")).alias("h")
    ).join(heads, "base", "left")
    rows = rows.withColumn("items", F.when(F.col("items").isNotNull() & (F.col("h") > 0), F.slice("items", 1, F.col("h"))))
    rows = rows.withColumn("head", F.when(F.col("items").isNull(), F.lit(0)).otherwise(F.size("items")).cast("long"))
    whole = F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    start = [
        F.coalesce(F.try_element_at("items", F.lit(-1))[m], F.lit(x)).cast("long").alias(f"h{m}")
        for m, x in zip(MAPS, ONE)
    ]
    rows = rows.withColumn("whole", whole).select("*", *start).drop("base")
    return materialize(rows, "heads")


def _prefixes(stored: DataFrame, convs: DataFrame) -> DataFrame:
    """Every rebuilt prefix: ``conv_id, depth``, its fingerprint ``f1, f2`` and its parent's, the key and
    length of its last turn, and whether the conversation ends there."""
    ends = F.col("depth") == F.col("whole")
    root = convs.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c) for c in ("f1", "f2", "p1", "p2", "k1", "k2", "n_chars")], (F.col("whole") == 0).alias("ends"),
    )
    last = ["k1", "k2", "n_chars"]
    links = [F.col("b1").alias("f1"), F.col("b2").alias("f2"), F.col("pb1").alias("p1"), F.col("pb2").alias("p2")]
    heads = convs.select("conv_id", "whole", F.inline("items")).withColumnRenamed("pos", "depth")
    heads = heads.select("conv_id", "depth", *links, *last, ends.alias("ends"))
    head = [f"h{m}" for m in MAPS]
    own = stored.select("conv_id", "idx", "n_chars", *KEYS).join(
        convs.select("conv_id", "first", "h", "head", *head), "conv_id"
    )
    own = own.withColumn("own", F.col("idx") - F.col("first") - F.col("h")).where("own >= 0")
    own = own.withColumn("depth", F.col("head") + F.col("own") + 1)
    own = own.withColumn("chunk", F.floor(F.col("own") / CHUNK))
    own = _products(own, "depth", head)
    if convs.where(F.col("n") - F.col("h") > CHUNK).isEmpty():
        run_on = own
    else:
        run_on = _carry(materialize(own, "chunks"))
    own = run_on.join(convs.select("conv_id", "whole"), "conv_id")
    own = own.select("conv_id", "depth", *links, *last, ends.alias("ends"))
    return materialize(root.unionByName(heads).unionByName(own), "prefixes")


def _nodes(prefixes: DataFrame) -> tuple[DataFrame, bool]:
    """``depth, f1, f2, conv_id, n_convs, n_chars, p1, p2``, and whether all members of every node have
    one parent and one last key."""
    checked = ["k1", "k2", "p1", "p2", "n_chars"]
    nodes = prefixes.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        *[F.min(c).alias(c) for c in checked],
        *[F.max(c).alias(f"most_{c}") for c in checked],
    )
    nodes = materialize(nodes, "nodes")
    differs = [F.col(c) != F.col(f"most_{c}") for c in checked]
    sound = nodes.where(differs[0] | differs[1] | differs[2] | differs[3] | differs[4]).isEmpty()
    return nodes.select(*NODE, "conv_id", "n_convs", "n_chars", "p1", "p2"), sound


def _turns_agree(stored: DataFrame) -> bool:
    """Whether stored turns that share a key have equal role and text."""
    spread = stored.groupBy("k1", "k2").agg(*[f(c).alias(f"{n}_{c}") for c in ("role", "text") for n, f in (("low", F.min), ("high", F.max))])
    return spread.where("low_role != high_role OR low_text != high_text").isEmpty()


def _end_digests(prefixes: DataFrame) -> DataFrame:
    """Per node the digest of the ids of the conversations that end there."""
    ends = prefixes.where("ends").select(*NODE, "conv_id")
    order = [*NODE, "conv_id"]

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*NODE, "first", "ids"]
        here, held = None, []

        def block():
            return pa.RecordBatch.from_arrays(
                [*(pa.array([x], pa.int64()) for x in (*here, held[0])), pa.array([",".join(map(str, held))])], names
            )

        for batch in batches:
            for *node, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
                if here is not None and (node != here or len(held) == BLOCK):
                    yield block()
                    held = []
                here = node
                held.append(conv_id)
        if held:
            yield block()

    blocks = ends.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = blocks.mapInArrow(texts, "depth long, f1 long, f2 long, first long, ids string")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state = None, None

        def done(rows):
            columns = [pa.array(c, pa.int64()) for c in zip(*(n for n, _ in rows))]
            return pa.RecordBatch.from_arrays([*columns, pa.array([d for _, d in rows])], [*NODE, "ends_sha256"])

        for batch in batches:
            rows = []
            for *node, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if node == here:
                    state.update(f",{ids}".encode())
                    continue
                if here is not None:
                    rows.append((here, state.hexdigest()))
                here, state = node, hashlib.sha256(ids.encode())
            if rows:
                yield done(rows)
        if here is not None:
            yield done([(here, state.hexdigest())])

    dealt = blocks.repartition(*NODE).sortWithinPartitions(*NODE, "first").select(*NODE, "ids")
    return dealt.mapInArrow(digests, "depth long, f1 long, f2 long, ends_sha256 string")


def _above(nodes: DataFrame) -> DataFrame:
    """``conv_id, depth, above``: the weights of the owner's nodes above, by running sums in two levels."""
    block = F.floor(F.col("depth") / CHUNK).alias("block")
    rows = nodes.select("conv_id", "depth", "w", block)
    within = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv_id", "block").agg(F.sum("w").alias("w"))
    over = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "block", F.coalesce(F.sum("w").over(over), F.lit(0)).alias("blocks"))
    rows = rows.select("conv_id", "depth", "block", F.coalesce(F.sum("w").over(within), F.lit(0)).alias("inside"))
    return rows.join(sums, ["conv_id", "block"]).select(
        "conv_id", "depth", (F.col("inside") + F.col("blocks")).alias("above")
    )


def prefix_trie(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per node: ``conv_id`` (its smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``. A node is found again as the first ``depth`` rebuilt turns of
    ``conv_id``."""
    columns = {"conv_id": conv_id, "turn": turn, "role": role, "text": text}
    for salt in count():
        stored = _stored(conversations, columns, salt)
        if not _turns_agree(stored):
            continue
        prefixes = _prefixes(stored, _conversations(stored))
        nodes, sound = _nodes(prefixes)
        if sound:
            return _describe(prefixes, nodes)


def _describe(prefixes: DataFrame, nodes: DataFrame) -> DataFrame:
    nodes = nodes.withColumn("w", (F.col("n_convs") - 1) * F.col("n_chars"))
    # A conversation owns the nodes from its top to its end.
    owners = nodes.groupBy("conv_id").agg(
        F.min_by(F.struct("depth", "p1", "p2"), "depth").alias("top"),
        F.max("depth").alias("bottom"),
        F.sum("w").alias("owned"),
    )
    owners = owners.select("conv_id", "top.*", "bottom", "owned").withColumnRenamed("depth", "top")
    parent = nodes.select(
        (F.col("depth") + 1).alias("top"), F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("conv_id").alias("over")
    )
    owners = materialize(owners.join(parent, ["top", "p1", "p2"], "left"), "owners")
    # Childless ends: no top hangs below them.
    tops = owners.where("top > 0").groupBy((F.col("top") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2"))
    tops = tops.agg(F.count("*").alias("hanging"))
    rows = nodes.join(owners.select("conv_id", "top", "bottom", "over", "owned"), "conv_id")
    rows = rows.join(tops, NODE, "left").withColumn(
        "n_children", F.coalesce("hanging", F.lit(0)) + (F.col("depth") < F.col("bottom")).cast("long")
    )
    rows = materialize(rows.drop("hanging", "p1", "p2"), "owned")
    ends = rows.where("depth = bottom").select(
        "conv_id", "owned", (F.col("n_children") == 0).cast("long").alias("leaf")
    )
    below = prefixes.select("conv_id", *NODE).join(ends, "conv_id").groupBy(*NODE)
    below = below.agg(F.sum("leaf").alias("n_leaves"), F.sum("owned").alias("members_own"))
    whole = rows.join(below, NODE).join(_above(nodes), ["conv_id", "depth"])
    whole = whole.join(_end_digests(prefixes), NODE, "left")
    none = hashlib.sha256(b"").hexdigest()
    owner = F.when(F.col("depth") == F.col("top"), F.col("over")).otherwise(F.col("conv_id"))
    return whole.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, owner).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("members_own") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )
