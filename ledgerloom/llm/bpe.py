"""Byte-level BPE without a regular expression in the tasks.

1.  The texts of an Arrow batch become one array of code points, with a mark after each text, and
    that an array of classes (letter, number, white space, apostrophe, ...).
2.  Each class is a function from states to states of a small automaton for the pre-tokenisation
    pattern. The functions generate a small monoid, so composing two is one table look-up, and as
    composition is associative, the states at all positions come from a prefix scan over the array:
    down the columns of a block layout, over the blocks' totals, and back.
3.  State and class tell where tokens begin. The slices are looked up in a bounded cache of merged
    pieces; a missing one is merged by ranks, lowest pair first, all missing ones of a batch together.
4.  The ids keep the byte offset of each token, and decoding writes every token's bytes there.

Defined results: null text is empty; an empty text has no ids. Bytes that are not UTF-8 are encoded
as U+FFFD. Repeated rows are encoded alike. Further columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.words import Piece, pieces

CACHE_PIECES = 200_000
END = 0x110000  # the mark after each text; no code point

# Classes. The letters that contractions are made of are classes of their own.
SPACE, WHITE, NUMBER, OTHER, APOSTROPHE, LETTER, E, L, RV, STMD, STOP = range(11)
# States: what the last character was part of.
FRESH, IN_WORD, IN_NUMBER, IN_OTHER, AT_SPACE, AT_WHITE, QUOTE, QUOTE_RV, QUOTE_L = range(9)
NO_PAIR = 2**31 - 1
VECTOR_BYTES = 64  # longer pieces are merged one by one
_ID_BITS = 24
HERE, BEFORE = 1, 2  # a token begins at this character; at the one before


def _step(state: int, kind: int) -> tuple[int, int]:
    """The next state, and where tokens begin, for
    ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``."""
    # After "'r", "'v" or "'l" that comes to nothing, the letter began a word.
    late = BEFORE if state in (QUOTE_RV, QUOTE_L) else 0
    if late and not (kind == E and state == QUOTE_RV) and not (kind == L and state == QUOTE_L):
        after, marks = _step(IN_WORD, kind)
        return after, marks | late
    if kind == STOP:
        return FRESH, HERE
    if kind in (SPACE, WHITE):
        begins = 0 if state in (AT_SPACE, AT_WHITE) else HERE
        return (AT_SPACE if kind == SPACE else AT_WHITE), begins
    if late:
        return FRESH, 0
    # The last white space before other characters stands apart from the rest of its run; a plain
    # space joins what follows.
    joins = state == AT_SPACE
    marks = BEFORE if joins else BEFORE | HERE if state == AT_WHITE else HERE
    if kind == NUMBER:
        return IN_NUMBER, 0 if state == IN_NUMBER else marks
    if kind in (OTHER, APOSTROPHE):
        if state in (IN_OTHER, QUOTE):
            return IN_OTHER, 0
        return (IN_OTHER if kind == OTHER or joins else QUOTE), marks
    if state == QUOTE and kind in (STMD, RV, L):
        return {STMD: FRESH, RV: QUOTE_RV, L: QUOTE_L}[kind], 0
    return IN_WORD, 0 if state == IN_WORD else marks


class Automaton:
    """The pattern's transition functions, closed under composition."""

    def __init__(self) -> None:
        states, kinds = range(QUOTE_L + 1), range(STOP + 1)
        one = tuple(states)
        of_kind = [tuple(_step(s, k)[0] for s in states) for k in kinds]
        self.marks = np.array([[_step(s, k)[1] for s in states] for k in kinds], np.uint8).ravel()
        found = {one: 0}
        queue = [one]
        for f in queue:
            for g in of_kind:
                h = tuple(g[f[s]] for s in states)
                if h not in found:
                    found[h] = len(found)
                    queue.append(h)
        n = self.size = len(queue)
        table = np.array(queue, np.uint8)
        self.apply = table.ravel()
        self.states = len(one)
        self.of_kind = np.array([found[f] for f in of_kind], np.uint16)
        composed = np.array([[found[tuple(g[x] for x in f)] for g in queue] for f in queue])
        self.compose = composed.astype(np.uint16).ravel()  # first f, then g: [f * n + g]
        self.width = np.uint32(n)

    def _scan(self, f: np.ndarray) -> np.ndarray:
        """Inclusive prefix compositions of functions."""
        n = len(f)
        if n <= 64:
            out = f.copy()
            for i in range(1, n):
                out[i] = self.compose[int(out[i - 1]) * self.size + int(out[i])]
            return out
        columns = 64 if n < 1 << 14 else 256
        rows = -(-n // columns)
        block = np.zeros(rows * columns, np.uint16)  # 0 is the identity
        block[:n] = f
        block = np.ascontiguousarray(block.reshape(rows, columns).T)
        for j in range(1, columns):
            block[j] = self.compose[block[j - 1] * self.width + block[j]]
        totals = self._scan(block[-1])
        block[:, 1:] = self.compose[totals[:-1] * self.width + block[:, 1:]]
        return np.ascontiguousarray(block.T).ravel()[:n]

    def starts(self, kinds: np.ndarray) -> np.ndarray:
        """Positions where tokens begin; every mark is one too."""
        functions = self._scan(self.of_kind[kinds])
        before = np.empty(len(kinds), np.uint8)
        before[0] = FRESH
        before[1:] = self.apply[functions[:-1] * np.uint32(self.states) + FRESH]
        marks = self.marks[kinds * np.uint16(self.states) + before]
        begins = (marks & HERE).astype(bool)
        begins[:-1] |= (marks[1:] & BEFORE).astype(bool)
        return np.flatnonzero(begins)


def class_table() -> np.ndarray:
    """The class of every code point, and of the mark."""
    import regex

    every = "".join(map(chr, (c for c in range(END) if not 0xD800 <= c < 0xE000)))
    table = np.full(END + 1, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (WHITE, r"\p{White_Space}")):
        table[[ord(c) for c in regex.findall(pattern, every)]] = kind
    table[ord(" ")], table[ord("'")], table[END] = SPACE, APOSTROPHE, STOP
    table[ord("e")], table[ord("l")] = E, L
    table[[ord(c) for c in "rv"]] = RV
    table[[ord(c) for c in "stmd"]] = STMD
    return table


class Vocabulary(NamedTuple):
    """What encoding needs; its size is that of the rank file, whatever the texts."""

    tokens: list[bytes]  # by id, which is the rank
    kinds: np.ndarray  # the class of every code point
    pair_keys: np.ndarray  # a hash table of the pairs that merge, -1 where free
    pair_ids: np.ndarray


def load_tokens(path: str) -> list[bytes]:
    with open(path, "rb") as lines:
        token_of = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [token_of.get(i, b"") for i in range(max(token_of) + 1)]


def load_vocabulary(path: str) -> Vocabulary:
    tokens = load_tokens(path)
    ranks = {token: i for i, token in enumerate(tokens) if token}
    keys, ids = [], []
    for token, i in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                keys.append(a << _ID_BITS | b)
                ids.append(i)
    return Vocabulary(tokens, class_table(), *_hash_table(np.array(keys), np.array(ids)))


def _slots(keys: np.ndarray, size: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(65 - size.bit_length())).astype(np.int64)


def _hash_table(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Open addressing at a quarter full."""
    size = 1 << (4 * len(keys)).bit_length()
    table, values = np.full(size, -1, np.int64), np.full(size, NO_PAIR, np.int32)
    slots, rest = _slots(keys, size), np.arange(len(keys))
    while len(rest):
        slot = slots[rest] % size
        free = np.flatnonzero(table[slot] < 0)
        _, first = np.unique(slot[free], return_index=True)
        won = free[first]
        table[slot[won]], values[slot[won]] = keys[rest[won]], ids[rest[won]]
        rest = np.delete(rest, won)
        slots[rest] += 1
    return table, values


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece: the adjacent pair of lowest rank is merged first, leftmost of ties."""
    n = len(piece)
    # A heap of pairs over a linked list; stale entries are skipped.
    end, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapify(heap)
    alive = [True] * n
    while heap:
        _, i, until = heappop(heap)
        j = right[i]
        if not alive[i] or j >= n or end[j] != until:
            continue
        alive[j] = False
        end[i], right[i] = until, right[j]
        if right[i] < n:
            left[right[i]] = i
            if (r := ranks.get(piece[i : end[right[i]]])) is not None:
                heappush(heap, (r, i, end[right[i]]))
        if left[i] >= 0 and (r := ranks.get(piece[left[i] : until])) is not None:
            heappush(heap, (r, left[i], until))
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


def _spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenated ranges ``start, ..., start + count - 1``."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


class Encoder:
    """State of one task: automaton, ranks and the cache of merged pieces."""

    def __init__(self, vocabulary: Vocabulary, most_pieces: int = CACHE_PIECES) -> None:
        self.automaton = Automaton()
        self.kinds = vocabulary.kinds
        self.ranks = {token: i for i, token in enumerate(vocabulary.tokens) if token}
        self.lengths = np.array([len(t) for t in vocabulary.tokens], np.int64)
        self.pair_keys, self.pair_ids = vocabulary.pair_keys, vocabulary.pair_ids
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.most = most_pieces
        self._clear()

    def _clear(self) -> None:
        self.cache: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.ends = np.zeros(0, np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged ids of pairs, which are their ranks; NO_PAIR where they do not merge."""
        keys = left << _ID_BITS | right
        slots = _slots(keys, len(self.pair_keys))
        out = np.full(len(keys), NO_PAIR, np.int32)
        rest = np.arange(len(keys))
        while len(rest):
            slot = slots[rest] & (len(self.pair_keys) - 1)
            found = self.pair_keys[slot]
            hit = found == keys[rest]
            out[rest[hit]] = self.pair_ids[slot[hit]]
            rest = rest[~hit & (found >= 0)]
            slots[rest] += 1
        return out

    def merge_all(self, slices: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pieces, and the number of ids of each. In each round every piece merges its
        adjacent pair of lowest rank, leftmost of ties."""
        ids = self.byte_ids[np.frombuffer(b"".join(slices), np.uint8)]
        owner = np.repeat(np.arange(len(slices)), [len(s) for s in slices])
        rank = np.full(len(ids), NO_PAIR, np.int32)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self.pairs(ids[inner], ids[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            begins = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            sizes = np.diff(np.concatenate((begins, [len(ids)])))
            least = np.minimum.reduceat(rank, begins)
            over = np.repeat(least == NO_PAIR, sizes)
            if over.any():
                done.append((owner[over], ids[over]))
                ids, owner, rank = ids[~over], owner[~over], rank[~over]
                sizes, least = sizes[least != NO_PAIR], least[least != NO_PAIR]
                if not len(ids):
                    break
            at = np.flatnonzero(rank == np.repeat(least, sizes))
            at = at[np.concatenate(([True], owner[at[1:]] != owner[at[:-1]]))]
            ids[at] = rank[at]
            stays = np.ones(len(ids), bool)
            stays[at + 1] = False
            moved = at - np.arange(len(at))
            ids, owner, rank = ids[stays], owner[stays], rank[stays]
            rank[moved] = NO_PAIR
            changed = np.concatenate((moved, moved[moved > 0] - 1))
            changed = changed[changed + 1 < len(ids)]
            changed = changed[owner[changed] == owner[changed + 1]]
            rank[changed] = self.pairs(ids[changed], ids[changed + 1])
        if not done:
            return np.zeros(0, np.int32), np.zeros(len(slices), np.int64)
        owner, ids = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(owner, kind="stable")
        return ids[order].astype(np.int32), np.bincount(owner, minlength=len(slices))

    def _learn(self, missing: list[bytes]) -> None:
        """Adds pieces to the cache."""
        short = [s for s in missing if len(s) <= VECTOR_BYTES]
        long = [s for s in missing if len(s) > VECTOR_BYTES]
        ids, counts = self.merge_all(short)
        more = [merge(s, self.ranks) for s in long]
        self.cache.update(zip(short + long, range(len(self.ends), len(self.ends) + len(missing))))
        added = np.concatenate((counts, np.array([len(m) for m in more], np.int64)))
        self.ends = np.concatenate((self.ends, len(self.ids) + np.cumsum(added)))
        self.ids = np.concatenate((self.ids, ids, *(np.array(m, np.int32) for m in more)))

    def boundaries(self, piece: Piece) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The texts' bytes, where tokens and ends of texts are in them, and which are ends."""
        raw = piece.data.tobytes()
        offsets = piece.offsets
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            spans = zip(offsets[:-1].tolist(), offsets[1:].tolist())
            texts = [raw[a:b].decode(errors="replace").encode() for a, b in spans]
            raw = b"".join(texts)
            offsets = np.cumsum([0, *map(len, texts)])
            text = raw.decode()
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        leads = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
        at = np.searchsorted(leads, offsets[1:])
        marked = np.insert(self.kinds[points], at, STOP)
        byte_of = np.insert(leads, at, offsets[1:])
        starts = self.automaton.starts(marked)
        return raw, byte_of[starts], marked[starts] == STOP

    def encode(self, piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, their byte offsets in their text, and the number of ids before each text."""
        raw, at, is_end = self.boundaries(piece)
        tokens = np.flatnonzero(~is_end)
        begins, ends = at[tokens].tolist(), at[tokens + 1].tolist()
        slices = [raw[a:b] for a, b in zip(begins, ends)]
        if len(self.cache) > self.most:
            self._clear()
        places = list(map(self.cache.get, slices))
        if None in places:
            self._learn(list({s for s, p in zip(slices, places) if p is None}))
            places = list(map(self.cache.__getitem__, slices))
        place = np.array(places, np.int64)
        start = np.concatenate(([0], self.ends[:-1]))
        counts = (self.ends - start)[place] if len(place) else place
        ids = self.ids[_spans(start[place], counts)] if len(place) else self.ids[:0]
        before = np.concatenate(([0], np.cumsum(counts)))
        # Ends come after all tokens of their text.
        tokens_before = np.flatnonzero(is_end) - np.arange(int(is_end.sum()))
        first = np.concatenate(([0], before[tokens_before]))
        byte = np.concatenate(([0], np.cumsum(self.lengths[ids])))
        offsets = byte[:-1] - np.repeat(byte[first[:-1]], np.diff(first))
        return ids, offsets.astype(np.int32), first


def encode_documents(
    docs: DataFrame,
    rank_file: str,
    doc_id: str = "doc_id",
    text: str = "text",
    most_pieces: int = CACHE_PIECES,
) -> DataFrame:
    """``doc_id, ids, offsets`` per row: token ids, and each token's first byte in the text."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(tuple(load_vocabulary(rank_file)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*vocabulary.value), most_pieces)
        for batch in batches:
            for piece in pieces(batch.column(1)):
                ids, offsets, first = encoder.encode(piece)
                at = pa.array(first.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.begin, piece.end - piece.begin),
                        pa.ListArray.from_arrays(at, pa.array(ids)),
                        pa.ListArray.from_arrays(at, pa.array(offsets)),
                    ],
                    ["doc_id", "ids", "offsets"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, offsets array<int>")


class Decoder:
    """Writes token bytes at their offsets."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.every = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray, first: np.ndarray) -> pa.Array:
        """One binary value per text; ``first`` is the number of ids before each text."""
        counts = self.lengths[ids]
        # A text's size is where its last token ends.
        filled = first[1:] > first[:-1]
        sizes = np.zeros(len(first) - 1, np.int64)
        last = first[1:][filled] - 1
        sizes[filled] = offsets[last] + counts[last]
        start = np.concatenate(([0], np.cumsum(sizes)))
        out = np.zeros(int(start[-1]), np.uint8)
        goal = offsets + np.repeat(start[:-1], np.diff(first))
        out[_spans(goal, counts)] = self.every[_spans(self.begins[ids], counts)]
        buffers = [None, pa.py_buffer(start.astype(np.int32)), pa.py_buffer(out)]
        return pa.Array.from_buffers(pa.binary(), len(sizes), buffers)


def decode_documents(encoded: DataFrame, rank_file: str) -> DataFrame:
    """``doc_id, ids, decoded`` per row of ``encode_documents``; ``decoded`` is binary."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(load_tokens(rank_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary.value)
        for batch in batches:
            lists = batch.column(1)
            ids = lists.flatten().to_numpy()
            offsets = batch.column(2).flatten().to_numpy().astype(np.int64)
            first = np.concatenate(([0], np.cumsum(np.diff(lists.offsets.to_numpy()))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists, decoder.decode(ids, offsets, first)],
                ["doc_id", "ids", "decoded"],
            )

    return encoded.select("doc_id", "ids", "offsets").mapInArrow(
        run, "doc_id long, ids array<int>, decoded binary"
    )


def round_trip(
    docs: DataFrame,
    rank_file: str,
    doc_id: str = "doc_id",
    text: str = "text",
    most_pieces: int = CACHE_PIECES,
) -> DataFrame:
    """``decode_documents(encode_documents(docs))`` in one Python process per task."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(tuple(load_vocabulary(rank_file)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Vocabulary(*vocabulary.value)
        encoder, decoder = Encoder(held, most_pieces), Decoder(held.tokens)
        for batch in batches:
            for piece in pieces(batch.column(1)):
                ids, offsets, first = encoder.encode(piece)
                at = pa.array(first.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.begin, piece.end - piece.begin),
                        pa.ListArray.from_arrays(at, pa.array(ids)),
                        decoder.decode(ids, offsets.astype(np.int64), first),
                    ],
                    ["doc_id", "ids", "decoded"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def token_digests(decoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of ``decode_documents``."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
