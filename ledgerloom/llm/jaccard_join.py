"""N-gram Jaccard join by blocked products of the sparse document by n-gram incidence matrix.

1.  *Incidence.* A document's row is the set of its distinct word n-grams, as 64-bit hashes. One
    pass gives every row's size and 128-bit fingerprint, and a count sketch of fixed size over all
    n-grams. Rows with equal sets are one class from here on; a task drops its own copies.
2.  *Bounds.* Two rows that link share at least ``ceil(0.85 n)`` n-grams of the larger, so they
    share one among the ``n - ceil(0.85 n) + 1`` first of either, in any fixed order. The order is
    rare first by the sketch, so what many documents share is rarely looked at. Only these entries
    are shuffled, by column, under the set's fingerprint, so equal sets count once. A column with few
    entries gives pairs that the size and position bounds cannot exclude, unless both rows have the
    same entry before this one too and so meet in its column; one with many gives only its members.
3.  *Parity.* In a corpus of any size most rows share some n-gram by chance. Sets whose parity bits
    differ in ``d`` places differ in ``d`` n-grams at least, so pairs and the members of a column are
    connected only where the bits of the two sets cannot exclude that they link.
4.  *Blocks.* Documents that are still connected form a family, and only they are read
    again. A family is cut into blocks by size, and a task multiplies the incidence of a block by
    its transpose, adding up overlap counts over slices of columns. A family of one block is done.
    In a larger one every block also meets an anchor block; afterwards only the documents outside
    the family's largest component meet all blocks of sizes that they can link with. So a large
    group of near copies costs its blocks, not its pairs, and no link between components is missed.
5.  A task returns what its links connect, as links to the smallest. Components come from these.

Defined results: null texts and texts without words have an empty set and link with nothing. Rows
without an id get their size and no component. Rows that repeat an id are one document, linked by
either text. Columns other than id and text are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.graph import components
from ledgerloom.llm.words import Hasher, mix, pieces
from ledgerloom.operators.index import dense_index
from ledgerloom.session import materialize

WIDTH = 4
LEAST_PERCENT = 85
SKETCH_BITS = 20
_CHUNKS = 64
_SALTS = 64
COLUMN_PAIRS = 64  # columns with more entries go to the blocks without pairs
SALTED_ENTRIES = 100_000  # columns that may have more are dealt out over several tasks
BLOCK_ROWS = 1024
VERIFIED_MEMBERS = 20_000  # columns with more make a family without a look at their parity bits
NODE_BITS = 23
LEAST_BITS, MOST_BITS = 1 << 8, 1 << 16
_SLICE = 4096


def _fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    spread = mix(hashes)
    low = np.bitwise_xor.reduce(mix(spread ^ np.uint64(0x5851F42D4C957F2D)))
    return int(spread.sum(dtype=np.uint64).view(np.int64)), int(low.view(np.int64))


def _parity(hashes: np.ndarray) -> bytes:
    """Parity bits of a set, about as many as it has members: a hash turns over the bit at its lowest
    digits, so the upper half folded on the lower one is the set's parity in half as many bits."""
    bits = min(max(LEAST_BITS, 1 << (len(hashes) - 1).bit_length()), MOST_BITS)
    count = np.bincount((hashes & np.uint64(bits - 1)).view(np.int64), minlength=bits)
    return np.packbits((count & 1).astype(bool), bitorder="little").tobytes()


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Rows of parity words in ``width`` words."""
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _parity_words(bits: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By number of words: the rows with so many, and their parity words."""
    if isinstance(bits, pa.ChunkedArray):
        bits = bits.combine_chunks()
    wide = pa.types.is_large_binary(bits.type)
    _, place, content = bits.buffers()
    offsets = np.frombuffer(place, np.int64 if wide else np.int32)
    offsets = offsets[bits.offset : bits.offset + len(bits) + 1].astype(np.int64)
    data = np.frombuffer(content, np.uint8)
    size = np.diff(offsets)
    out = {}
    for n in np.unique(size).tolist():
        rows = np.flatnonzero(size == n)
        out[n // 8] = rows, data[offsets[rows][:, None] + np.arange(n)].view(np.uint64)
    return out


def _most_differing(n: np.ndarray, m: np.ndarray, least: int) -> np.ndarray:
    """In how many members sets of these sizes that link differ at most; -1 where no such sets do."""
    shared = -(-least * (n + m) // (100 + least))
    fits = 100 * np.minimum(n, m) >= least * np.maximum(n, m)
    return np.where(fits, n + m - 2 * shared, -1)


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, pa.int64())


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def signatures(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH
) -> tuple[DataFrame, np.ndarray]:
    """``doc_id, n, hi, lo, bits`` per row, and the sketch: how many n-grams fall in each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        cells = np.zeros(1 << SKETCH_BITS, np.int64)
        names = ["doc_id", "n", "hi", "lo", "bits", "chunk", "counts"]
        for batch in batches:
            for piece in pieces(batch.column(1)):
                n, hi, lo, bits = [], [], [], []
                for own in hasher.shingle_sets(piece, width):
                    n.append(len(own))
                    a, b = _fingerprint(own) if len(own) else (0, 0)
                    hi.append(a)
                    lo.append(b)
                    bits.append(_parity(own) if len(own) else None)
                    cell = (own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
                    np.add.at(cells, cell, 1)
                k = len(n)
                ids = batch.column(0).slice(piece.begin, k)
                columns = [ids, *(pa.array(x, pa.int64()) for x in (n, hi, lo)), pa.array(bits, pa.binary())]
                nothing = [pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns + nothing, names)
        if cells.any():
            parts = [x.tobytes() for x in np.split(cells.astype(np.uint32), _CHUNKS)]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(_CHUNKS, pa.int64())] * 4
                + [pa.nulls(_CHUNKS, pa.binary())]
                + [pa.array(range(_CHUNKS), pa.int64()), pa.array(parts, pa.binary())],
                names,
            )

    schema = "doc_id long, n long, hi long, lo long, bits binary, chunk long, counts binary"
    found = materialize(_rows(docs, doc_id, text).mapInArrow(run, schema), "signatures")
    sketch = np.zeros(1 << SKETCH_BITS, np.int64)
    size = len(sketch) // _CHUNKS
    for row in _sum_chunks(found.where("chunk IS NOT NULL").select("chunk", "counts")).collect():
        sketch[row.chunk * size : (row.chunk + 1) * size] = np.frombuffer(row.counts, np.int64)
    return found.where("chunk IS NULL").select("doc_id", "n", "hi", "lo", "bits"), sketch


def _sum_chunks(parts: DataFrame) -> DataFrame:
    """One row of summed counts per chunk: first within salts, then over them."""

    def add(kind: type):
        def run(table: pa.Table) -> pa.Table:
            arrays = (np.frombuffer(x, kind) for x in table.column("counts").to_pylist())
            total = sum(arrays, np.int64(0)).tobytes()
            return table.slice(0, 1).select(["chunk"]).append_column("counts", pa.array([total]))

        return run

    schema = "chunk long, counts binary"
    salted = parts.withColumn("salt", F.spark_partition_id() % _SALTS).groupBy("chunk", "salt")
    return salted.applyInArrow(add(np.uint32), schema).groupBy("chunk").applyInArrow(add(np.int64), schema)


def _entries(
    docs: DataFrame, doc_id: str, text: str, width: int, least: int, sketch: np.ndarray
) -> DataFrame:
    """``g, node, place, more``: the entries of the first columns of every row; ``node`` is half of the
    set's fingerprint, ``place`` holds size and position, ``more`` a salt, which is not 0 where the
    sketch cannot exclude that the column is huge, and digits of the row's entry before this one."""
    cells = docs.sparkSession.sparkContext.broadcast(sketch)
    hot = float(sketch.mean()) + SALTED_ENTRIES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counts, seen = Hasher(), cells.value, set()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for piece in pieces(batch.column(1)):
                g, node, place, more = [], [], [], []
                for i, own in enumerate(hasher.shingle_sets(piece, width), piece.begin):
                    n = len(own)
                    if not n or ids[i] is None or (mark := _fingerprint(own)) in seen:
                        continue
                    seen.add(mark)
                    first = n - (least * n + 99) // 100 + 1
                    count = counts[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                    key = np.left_shift(count, 32) | np.arange(n)
                    key = np.sort(np.partition(key, first - 1)[:first] if first < n else key)
                    g.append(own[key & 0xFFFFFFFF])
                    node.append(np.full(first, mark[0]))
                    place.append(n << 32 | np.arange(first))
                    salt = np.where(key >> 32 >= hot, 1 + mark[0] % _SALTS, 0)
                    salt[1:] = salt[1:] << 32 | (g[-1][:-1] & np.uint64(0xFFFFFFFF)).view(np.int64)
                    salt[0] <<= 32
                    more.append(salt)
                if g:
                    columns = [_long(np.concatenate(x)) for x in (g, node, place, more)]
                    yield pa.RecordBatch.from_arrays(columns, ["g", "node", "place", "more"])

    schema = "g long, node long, place long, more long"
    return _rows(docs, doc_id, text).mapInArrow(run, schema)


def _candidates(entries: DataFrame, least: int) -> DataFrame:
    """``a, b, g``: pairs that sizes and positions cannot exclude (``g`` null), or
    members ``a`` of a column ``g`` with too many entries for pairs (``b`` null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "g"]
        kept = np.zeros((0, 4), np.int64)
        crowded: int | None = None  # the last column, if it is known to have many entries

        def once(rows: np.ndarray) -> np.ndarray:
            """Equal sets of different tasks are one entry."""
            rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
            new = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
            return rows[np.concatenate(([True], new))]

        def members(rows: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [_long(rows[:, 1].copy()), pa.nulls(len(rows), pa.int64()), _long(rows[:, 0].copy())],
                names,
            )

        def finish(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            """All entries of some columns."""
            rows = once(rows)
            change = np.flatnonzero(np.concatenate(([True], rows[1:, 0] != rows[:-1, 0])))
            sizes = np.diff(np.concatenate((change, [len(rows)])))
            size = np.repeat(sizes, sizes)
            many = (size > COLUMN_PAIRS) | (rows[:, 3] >> 32 > 0)
            if many.any():
                yield members(rows[many])
            rows = rows[~many & (size > 1)]
            found = []
            for step in range(1, COLUMN_PAIRS):
                same = np.flatnonzero(rows[step:, 0] == rows[:-step, 0])
                if not len(same):
                    break
                x, y = rows[same], rows[same + step]
                n, m = x[:, 2] >> 32, y[:, 2] >> 32
                i, j = x[:, 2] & 0xFFFFFFFF, y[:, 2] & 0xFFFFFFFF
                # Where the entries before are one n-gram, this is not the first that the two share.
                later = (i > 0) & (j > 0) & (x[:, 3] == y[:, 3])
                # What comes before the first n-gram they share is in one of them only.
                fits = ~later & (i + j <= _most_differing(n, m, least))
                found.append(np.sort(np.column_stack((x[fits, 1], y[fits, 1])), axis=1))
            if found and len(pairs := np.concatenate(found)):
                sides = [_long(pairs[:, k].copy()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*sides, pa.nulls(len(pairs), pa.int64())], names)

        for batch in batches:
            rows = np.column_stack([c.to_numpy() for c in batch.columns])
            if crowded is not None:
                more = int(np.argmax(rows[:, 0] != crowded)) if (rows[:, 0] != crowded).any() else len(rows)
                if more:
                    yield members(rows[:more])
                rows = rows[more:]
                if not len(rows):
                    continue
                crowded = None
            rows = np.concatenate((kept, rows))
            if not len(rows):
                continue
            start = int(np.argmax(rows[:, 0] == rows[-1, 0]))
            if start:
                yield from finish(rows[:start])
            kept = once(rows[start:])
            if len(kept) > COLUMN_PAIRS:
                yield members(kept)
                crowded, kept = int(kept[0, 0]), kept[:0]
        if len(kept):
            yield from finish(kept)

    dealt = entries.repartition("g", F.shiftright("more", 32))
    return dealt.sortWithinPartitions("g").mapInArrow(run, "a long, b long, g long")


def _possible_pairs(least: int):
    """Of pairs with sizes and parity bits those that these cannot exclude."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, m = batch.column("a_n").to_numpy(), batch.column("b_n").to_numpy()
            most = _most_differing(n, m, least)
            possible = np.zeros(batch.num_rows, bool)
            of_a, of_b = (_parity_words(batch.column(c)) for c in ("a_bits", "b_bits"))
            for a_width, (a_rows, a_bits) in of_a.items():
                for b_width, (b_rows, b_bits) in of_b.items():
                    rows, x, y = np.intersect1d(a_rows, b_rows, assume_unique=True, return_indices=True)
                    if len(rows):
                        width = min(a_width, b_width)
                        differ = _folded(a_bits[x], width) ^ _folded(b_bits[y], width)
                        possible[rows] = np.bitwise_count(differ).sum(axis=1, dtype=np.int64) <= most[rows]
            yield batch.select(["a", "b"]).filter(pa.array(possible))

    return run


def _possible_members(least: int):
    """What the members of one column connect that parity bits cannot exclude."""

    def run(table: pa.Table) -> pa.Table:
        node, n = table.column("class").to_numpy(), table.column("n").to_numpy()
        words = _parity_words(table.column("bits"))
        # By width: rows of this width and, folded, of those above that fit in size.
        widest = 1 << (-(-100 // max(least, 1)) - 1).bit_length()
        levels = []
        width_of = np.zeros(len(node), np.int64)
        for width, (rows, _) in words.items():
            width_of[rows] = width
            held = [(r, _folded(bits, width)) for w, (r, bits) in words.items() if width <= w <= widest * width]
            levels.append((width, *(np.concatenate(x) for x in zip(*held))))
        at = {w: {int(r): k for k, r in enumerate(rows)} for w, rows, _ in levels}
        left = np.ones(len(node), bool)
        links = []
        for root in np.argsort(node, kind="stable").tolist():
            if not left[root]:
                continue
            left[root] = False
            queue = [root]
            for i in queue:
                for width, rows, bits in levels:
                    if not width <= width_of[i] <= widest * width:
                        continue
                    near = np.flatnonzero(left[rows])
                    if width_of[i] > width:
                        near = near[width_of[rows[near]] == width]
                    most = _most_differing(n[i], n[rows[near]], least)
                    near, most = near[most >= 0], most[most >= 0]
                    if not len(near):
                        continue
                    differ = np.bitwise_count(bits[near] ^ bits[at[width][i]]).sum(axis=1, dtype=np.int64)
                    found = rows[near[differ <= most]]
                    left[found] = False
                    queue += found.tolist()
            links += [(int(node[root]), int(node[j])) for j in queue[1:]]
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _possible(candidates: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """``a, b``: classes that pairs or columns connect and that parity bits cannot exclude."""
    schema = "a long, b long"
    pairs = candidates.where("g IS NULL").select("a", "b").distinct()
    for side in ("a", "b"):
        own = classes.select(
            F.col("hi").alias(side), F.col("class").alias(f"{side}_class"),
            F.col("n").alias(f"{side}_n"), F.col("bits").alias(f"{side}_bits"),
        )
        pairs = pairs.join(own, side).drop(side).withColumnRenamed(f"{side}_class", f"{side}")
    near = materialize(pairs.mapInArrow(_possible_pairs(least), schema), "possible-pairs")
    members = candidates.where("g IS NOT NULL").select("g", F.col("a").alias("hi")).distinct()
    members = materialize(members, "column-members")
    counts = materialize(members.groupBy("g").agg(F.count("*").alias("m")).where("m > 1"), "column-sizes")
    fits = members.join(counts.where(F.col("m") <= VERIFIED_MEMBERS), "g", "left_semi")
    fits = fits.join(classes, "hi").select("g", "class", "n", "bits")
    near = near.unionByName(
        materialize(fits.groupBy("g").applyInArrow(_possible_members(least), schema), "possible-members")
    )
    huge = counts.where(F.col("m") > VERIFIED_MEMBERS)
    if huge.isEmpty():
        return near
    held = members.join(huge, "g", "left_semi").join(classes.select("hi", "class"), "hi")
    held = materialize(held.select("g", "class"), "huge-columns")
    centres = held.groupBy("g").agg(F.min("class").alias("a"))
    spokes = held.join(centres, "g").select("a", F.col("class").alias("b")).where("a != b")
    return near.unionByName(spokes)


def families(possible: DataFrame) -> DataFrame:
    """``node, family``: documents that may be linked, over any number of others."""
    return components(possible).withColumnRenamed("component", "family")


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The product of an incidence matrix and its transpose, over slices of shared columns."""
    m = len(sets)
    product = np.zeros((m, m))
    columns = np.concatenate(sets)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(columns, kind="stable")
    columns, row = columns[order], row[order]
    change = np.flatnonzero(np.concatenate(([True], columns[1:] != columns[:-1])))
    sizes = np.diff(np.concatenate((change, [len(columns)])))
    row = row[np.repeat(sizes > 1, sizes)]
    sizes = sizes[sizes > 1]
    column = np.repeat(np.arange(len(sizes)), sizes)
    for low in range(0, len(sizes), _SLICE):
        here = slice(*np.searchsorted(column, (low, low + _SLICE)))
        part = np.zeros((m, min(_SLICE, len(sizes) - low)), np.float32)
        part[row[here], column[here] - low] = 1
        product += part @ part.T
    return product


def _links(least: int):
    def run(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        # A node can be in its block and among the anchors or the rest.
        nodes, first = np.unique(nodes, return_index=True)
        values = table.column("hashes")
        sets = [np.frombuffer(values[int(i)].as_py(), np.uint64) for i in first]
        a: list[int] = []
        b: list[int] = []
        if len(sets) > 1:
            size = np.array([len(s) for s in sets])
            shared = _overlaps(sets)
            linked = 100 * shared >= least * (size[:, None] + size[None, :] - shared)
            left = np.ones(len(sets), bool)
            for root in range(len(sets)):
                if not left[root]:
                    continue
                left[root] = False
                queue = [root]
                for i in queue:
                    found = np.flatnonzero(linked[i] & left).tolist()
                    left[found] = False
                    queue += found
                # Nodes are in order, so the root is the smallest of its component.
                a += [int(nodes[root])] * (len(queue) - 1)
                b += [int(nodes[j]) for j in queue[1:]]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _placed(family: DataFrame, rows: DataFrame, least: int, block_rows: int) -> DataFrame:
    """``node, n, family, band, block, blocks, large``, without texts. Two documents that link are
    in the same or adjacent bands of size; ``blocks`` is how many the band has."""
    # A hair under the exact border, so rounding never skips a band.
    ratio = float(np.log(100 / least)) if least < 100 else 1.0
    band = F.floor(F.log(F.col("n").cast("double")) * F.lit((1 - 1e-9) / ratio)).alias("band")
    of = rows.where("n > 0").select(F.col("doc_id").alias("node"), "n")
    nodes = family.join(of, "node").select("node", "n", "family", band).distinct()
    nodes = materialize(nodes, "family-nodes")
    sizes = nodes.groupBy("family", "band").agg(F.count("*").alias("m"))
    total = sizes.groupBy("family").agg(F.sum("m").alias("all"))
    sizes = sizes.join(total, "family").select(
        "family",
        "band",
        (F.col("all") > block_rows).alias("large"),
        F.ceil(F.col("m") / F.lit(block_rows)).alias("blocks"),
    )
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block")
    return nodes.join(sizes, ["family", "band"]).select(
        "node", "n", "family", "band", block, "blocks", "large"
    )


def _in_table(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows (``doc_id, text``) whose id may be among ``ids``, by a table of bits of fixed size."""
    x = F.col("doc_id")
    cell = x.bitwiseXOR(F.shiftright(x, NODE_BITS)).bitwiseXOR(F.shiftright(x, 2 * NODE_BITS))
    cell = F.pmod(cell, F.lit(1 << NODE_BITS)) + 1  # Spark's bitmaps begin at 1
    parts = ids.select(cell.alias("cell")).groupBy(F.bitmap_bucket_number("cell").alias("part"))
    parts = parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")).collect()
    bits = np.zeros((1 << NODE_BITS) // 8, np.uint8)
    for row in parts:
        own = np.frombuffer(row.bits, np.uint8)
        bits[(row.part - 1) * len(own) : row.part * len(own)] = own
    table = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.filter(batch.column(0).is_valid())
            x = known.column(0).to_numpy()
            at = (x ^ x >> NODE_BITS ^ x >> 2 * NODE_BITS) & ((1 << NODE_BITS) - 1)
            yield known.filter(pa.array((table.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))

    return rows.mapInArrow(run, rows.schema)


def _sets(docs: DataFrame, nodes: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """``node, family, band, block, hashes`` of the given nodes.

    Texts are first thinned out by a table of ``2 ** NODE_BITS`` bits, which is small
    enough to broadcast whatever the corpus; the exact join then shuffles what is left.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        names = ["node", "family", "band", "block", "hashes"]
        for batch in batches:
            sizes = batch.column(1).to_pylist()
            for piece in pieces(batch.column(5)):
                sets = list(hasher.shingle_sets(piece, width))
                # Rows that repeat an id meet each other's places.
                own = pa.array([len(s) == n for s, n in zip(sets, sizes[piece.begin : piece.end])])
                columns = [batch.column(c).slice(piece.begin, len(sets)) for c in (0, 2, 3, 4)]
                columns.append(pa.array([s.tobytes() for s in sets], pa.binary()))
                yield pa.RecordBatch.from_arrays([c.filter(own) for c in columns], names)

    places = nodes.withColumnRenamed("node", "doc_id").select("doc_id", "n", "family", "band", "block")
    thin = _in_table(_rows(docs, doc_id, text), places.select("doc_id"))
    rows = thin.hint("merge").join(places, "doc_id").select(*places.columns, "text")
    return rows.mapInArrow(
        run, "node long, family long, band long, block long, hashes binary"
    )


def _block_links(
    docs: DataFrame, placed: DataFrame, doc_id: str, text: str, width: int, least: int, block_rows: int
) -> DataFrame:
    """``a, b``: enough links to connect all that are linked."""
    schema = "a long, b long"
    small = _sets(docs, placed.where("NOT large"), doc_id, text, width)
    done = materialize(small.groupBy("family").applyInArrow(_links(least), schema), "links")
    large = placed.where("large")
    if large.isEmpty():
        return done
    own = materialize(_sets(docs, large, doc_id, text, width), "large-families")
    shape = materialize(
        large.groupBy("family", "band").agg(F.max("blocks").alias("blocks")), "family-shapes"
    )
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    blocks = shape.select("family", "band", numbers(F.col("blocks")).alias("block"))
    near = F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band")
    anchors = own.where("block = 0").select("family", near, "node", "hashes")
    keys = ["family", "band", "block"]
    columns = [*keys, "node", "hashes"]
    anchored = anchors.join(blocks, ["family", "band"]).select(columns)
    within = own.select(columns).unionByName(anchored)
    within = materialize(within.groupBy(*keys).applyInArrow(_links(least), schema), "links")
    # What is not in its family's largest component meets all blocks it can link with, but for
    # those it has met: a band of one block is its own anchor.
    nodes = large.select("node", "family", "band", "block", "blocks")
    labelled = nodes.join(components(within), "node", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "node"))
    share = labelled.groupBy("family", "component").agg(F.count("*").alias("m"))
    largest = share.groupBy("family").agg(F.max(F.struct("m", "component")).alias("top"))
    rest = labelled.join(largest, "family").where(F.col("component") != F.col("top.component"))
    goal = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("goal")
    goals = shape.select("family", F.col("band").alias("goal"), F.col("blocks").alias("goal_blocks"))
    open_pair = F.when(F.col("goal") < F.col("band"), F.col("goal_blocks") > 1)
    rest = rest.select("node", "family", "band", "blocks", goal).join(goals, ["family", "goal"])
    rest = materialize(rest.where(open_pair.otherwise(F.col("blocks") > 1)), "outside-largest")
    if rest.isEmpty():
        return done.unionByName(within)
    parts = rest.groupBy("family", "goal").agg(F.ceil(F.count("*") / F.lit(block_rows)).alias("parts"))
    part = F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).alias("part")
    meets = ["family", "goal", "block", "part"]
    outside = rest.join(parts, ["family", "goal"]).select(
        "node", "family", "goal", numbers(F.col("goal_blocks")).alias("block"), part
    )
    inside = nodes.withColumnRenamed("band", "goal").join(parts, ["family", "goal"])
    inside = inside.select("node", "family", "goal", "block", numbers(F.col("parts")).alias("part"))
    meeting = outside.unionByName(inside).join(own.select("node", "hashes"), "node")
    across = meeting.groupBy(*meets).applyInArrow(_links(least), schema)
    return done.unionByName(within).unionByName(materialize(across, "links"))


def similarity_classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    least: int = LEAST_PERCENT,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs``: two documents link when their sets
    of ``width``-word shingles have a Jaccard ratio of at least ``least`` percent."""
    signed = signatures(docs, doc_id, text, width)
    rows = signed[0]
    several = rows.where("doc_id IS NOT NULL").groupBy("doc_id")
    sets = F.struct("n", "hi", "lo")
    several = several.agg(F.min(sets).alias("least"), F.max(sets).alias("most")).where("least != most")
    several = materialize(several.select("doc_id"), "ids-of-several-sets")
    how = (width, least, block_rows)
    if several.isEmpty():
        return _classes(docs, doc_id, text, signed, *how)
    return _classes_of_texts(docs, doc_id, text, rows, several, *how)


def _classes_of_texts(
    docs: DataFrame, doc_id: str, text: str, rows: DataFrame, several: DataFrame, *how: int
) -> DataFrame:
    """The same where ids stand on different texts: each such text gets an unused id of its own, and
    afterwards the components of one id's texts are one."""
    marks = ["id", "t1", "t2"]
    content = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(
        F.col(doc_id).cast("long").alias("id"),
        F.xxhash64(content).alias("t1"),
        F.xxhash64(F.octet_length(content), content).alias("t2"),
        F.col(text).alias("text"),
    )
    texts = own.join(several.withColumnRenamed("doc_id", "id"), "id", "left_semi").select(*marks).distinct()
    texts = dense_index(texts, marks, "at")
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    room = high < 2**62
    new = (F.lit(high) + 1 + F.col("at")) if room else (F.lit(low) - 1 - F.col("at"))
    texts = materialize(texts.select(*marks, new.alias("node")), "texts-of-ids")
    named = own.join(texts, marks, "left").select(F.coalesce("node", "id").alias("node"), "text")
    named = materialize(named, "named-texts")
    found = _classes(named, "node", "text", signatures(named, "node", "text", how[0]), *how)
    found = materialize(found, "classes-of-texts")
    back = texts.select("node", "id")
    found = found.withColumnRenamed("doc_id", "node").join(back, "node", "left")
    found = found.select(F.coalesce("id", "node").alias("doc_id"), "n_shingles", "component_id")
    held = found.where("doc_id IS NOT NULL").select("doc_id", "component_id").distinct()
    star = held.groupBy("doc_id").agg(F.min("component_id").alias("a"))
    edges = held.join(star, "doc_id").select("a", F.col("component_id").alias("b")).where("a != b")
    joined = components(edges).withColumnRenamed("node", "component_id")
    held = held.join(joined, "component_id", "left")
    held = held.select("doc_id", F.coalesce("component", "component_id").alias("joined"))
    held = materialize(held.distinct(), "joined-components")
    smallest = held.groupBy("joined").agg(F.min("doc_id").alias("smallest"))
    labels = held.join(smallest, "joined").select("doc_id", "smallest")
    return found.join(labels, "doc_id", "left").select(
        "doc_id", "n_shingles", F.col("smallest").alias("component_id")
    )


def _classes(
    docs: DataFrame,
    doc_id: str,
    text: str,
    signed: tuple[DataFrame, np.ndarray],
    width: int,
    least: int,
    block_rows: int,
) -> DataFrame:
    """``similarity_classes`` where every id has one set."""
    rows, sketch = signed
    known = rows.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = known.groupBy("n", "hi", "lo").agg(F.min("doc_id").alias("class"), F.first("bits").alias("bits"))
    # A written table on one side and an exchange above let Spark split a hot class in the join.
    classes = materialize(classes, "set-classes")
    of_class = known.join(classes.drop("bits"), ["n", "hi", "lo"]).select("doc_id", "class")
    of_class = materialize(of_class.repartition("doc_id", "class").distinct(), "classes")
    found = materialize(
        _candidates(_entries(docs, doc_id, text, width, least, sketch), least), "candidates"
    )
    family = materialize(families(_possible(found, classes, least)), "families")
    placed = materialize(_placed(family, rows, least, block_rows), "family-places")
    # Only the first document of each class is in a family.
    links = _block_links(docs, placed, doc_id, text, width, least, block_rows)
    component = components(links).withColumnRenamed("node", "class")
    labels = of_class.join(component, "class", "left").select(
        "doc_id", F.coalesce("component", "class").alias("found")
    )
    return rows.join(labels, "doc_id", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("found", "doc_id").alias("component_id"),
    )


def keep_one_per_class(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, all columns as they were.
    Rows without an id stay."""
    found = similarity_classes(docs, doc_id, text, **how)
    dropped = found.where("doc_id != component_id").select(F.col("doc_id").alias("_dropped_id")).distinct()
    dropped = materialize(dropped, "near-duplicates")
    return docs.join(dropped, F.col(doc_id).cast("long") == F.col("_dropped_id"), "left_anti")
