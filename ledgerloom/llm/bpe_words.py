"""Byte-pair encoding with word ends: lower-cased words, merged by rank through a priority queue.

1.  A text is cut at the special tokens, which stand as themselves. What lies between is composed
    (NFC) and lower-cased, character by character.
2.  Words are contractions, runs of letters, single numbers and runs of other characters; white space
    goes. A word's UTF-8 bytes are its first symbols, the last one marked as the word's end.
3.  A word's symbols form a doubly linked list. A heap holds the adjacent pairs that merge, by rank,
    leftmost of ties; an entry whose pair has changed since is stale and skipped. The ids of common
    words are kept in a cache of bounded size.
4.  Decoding takes and joins the vocabulary strings of the ids, by a space, as such a vocabulary without a
    decoder prescribes: ``hello</w> world</w>``.

Defined results: null text is empty; an empty text, or one of white space only, has no ids. Bytes that
are not UTF-8 count as U+FFFD. Repeated rows are encoded alike, an empty table gives an empty one, and
further columns are ignored, whatever their names. Whole texts are encoded: one word's memory grows
with the word (20 bytes a byte), a task's with its longest text.
"""

from __future__ import annotations

import json
import re
import unicodedata
import uuid
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.words import pieces

CACHE_WORDS = 500_000
LONGEST_CACHED = 64  # characters
WORD_END = "</w>"

WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# The vocabulary's libraries follow other versions of Unicode than Python's do. Code
# points that are letters or numbers here and neither there,
LATER_CLASSES = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC),
    (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4),
    (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF),
    (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F),
    (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128),
    (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81),
    (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F),
)
# combining marks that do not combine there (and one pair that does not compose),
LATER_MARKS = (
    (0x7FD, 0x7FD), (0x898, 0x89F), (0x8CA, 0x8D3), (0x9FE, 0x9FE), (0xC3C, 0xC3C), (0xD3B, 0xD3C),
    (0xEBA, 0xEBA), (0x1715, 0x1715), (0x1ABF, 0x1ACE), (0x1DF6, 0x1DFA), (0xA82C, 0xA82C),
    (0x10D24, 0x10D27), (0x10EAB, 0x10EAC), (0x10EFD, 0x10EFF), (0x10F46, 0x10F50),
    (0x10F82, 0x10F85), (0x11070, 0x11070), (0x1133B, 0x1133B), (0x1145E, 0x1145E),
    (0x11839, 0x1183A), (0x11930, 0x11930), (0x11938, 0x11938), (0x1193D, 0x1193E),
    (0x11943, 0x11943), (0x119E0, 0x119E0), (0x11A34, 0x11A34), (0x11A47, 0x11A47),
    (0x11A99, 0x11A99), (0x11D42, 0x11D42), (0x11D44, 0x11D45), (0x11D97, 0x11D97),
    (0x11F41, 0x11F42), (0x16FF0, 0x16FF1), (0x1E08F, 0x1E08F), (0x1E130, 0x1E136),
    (0x1E2AE, 0x1E2AE), (0x1E2EC, 0x1E2EF), (0x1E4EC, 0x1E4EF),
)
# and capitals (first, last, distance of the small letter) that only there have a small letter.
LATER_CAPITALS = (
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, -42343), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1),
    (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, -42561), (0x10D50, 0x10D65, 32), (0x16EA0, 0x16EB8, 27),
)


def _class(ranges: tuple) -> str:
    return "".join(f"\\U{r[0]:08x}-\\U{r[1]:08x}" for r in ranges)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary strings: printable Latin-1 characters for
    themselves, the others moved behind U+0100 in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = iter(range(0x100, 0x200))
    shown = set(plain)
    return [chr(b) if b in shown else chr(next(moved)) for b in range(256)]


class Vocabulary(NamedTuple):
    """What encoding and decoding need; its size is that of the file, whatever the texts."""

    tokens: list[str]  # by id
    inner: list[int]  # id of every byte inside a word
    final: list[int]  # id of every byte that ends a word
    pairs: dict[int, int]  # left id and right id, to rank and merged id
    special: dict[str, int]


def load_vocabulary(path: str) -> Vocabulary:
    """Reads a ``tokenizers`` file of a byte-level BPE with word ends."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    ids: dict[str, int] = whole["model"]["vocab"]
    special = {t["content"]: t["id"] for t in whole["added_tokens"]}
    tokens = [""] * (max(*ids.values(), *special.values()) + 1)
    for token, i in (*ids.items(), *special.items()):
        tokens[i] = token
    pairs = {}
    for rank, (a, b) in enumerate(whole["model"]["merges"]):
        pairs[ids[a] << 24 | ids[b]] = rank << 24 | ids[a + b]
    letters = byte_letters()
    return Vocabulary(
        tokens, [ids[c] for c in letters], [ids[c + WORD_END] for c in letters], pairs, special
    )


def merge(word: bytes, words: Vocabulary) -> array:
    """The ids of one word: of its adjacent pairs the one of lowest rank merges, leftmost of ties."""
    n = len(word)
    inner, pair = words.inner, words.pairs.get
    symbol = [inner[b] for b in word]
    symbol[-1] = words.final[word[-1]]
    if n == 1:
        return array("i", symbol)
    heap = []  # rank and merged id of a pair, then the place of its left symbol
    for i in range(n - 1):
        found = pair(symbol[i] << 24 | symbol[i + 1])
        if found is not None:
            heap.append(found << 40 | i)
    heapify(heap)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    if n > LONGEST_CACHED:
        symbol, left, right = array("i", symbol), array("q", left), array("q", right)
    while heap:
        entry = heappop(heap)
        i = entry & 0xFFFFFFFFFF
        j = right[i]
        # Stale: merged into its neighbour, the last one now, or one of the two has grown.
        if symbol[i] < 0 or j >= n or pair(symbol[i] << 24 | symbol[j]) != entry >> 40:
            continue
        symbol[i] = merged = entry >> 40 & 0xFFFFFF
        symbol[j] = -1
        after = right[i] = right[j]
        if after < n:
            left[after] = i
            found = pair(merged << 24 | symbol[after])
            if found is not None:
                heappush(heap, found << 40 | i)
        before = left[i]
        if before >= 0:
            found = pair(symbol[before] << 24 | merged)
            if found is not None:
                heappush(heap, found << 40 | before)
    return array("i", [s for s in symbol if s >= 0])


class _Cache(dict):
    """Ids of words as little-endian bytes; a missing word is merged when it is asked for."""

    def __init__(self, words: Vocabulary) -> None:
        super().__init__()
        self.words = words

    def __missing__(self, word: str) -> bytes:
        ids = np.frombuffer(merge(word.encode(), self.words), np.int32).astype("<i4").tobytes()
        if len(word) <= LONGEST_CACHED:
            self[word] = ids
        return ids


class Encoder:
    """State of one task: patterns, and the cache of merged words."""

    def __init__(self, words: Vocabulary, most_words: int = CACHE_WORDS) -> None:
        self.cache, self.most = _Cache(words), most_words
        self.special = {t: np.array([i], "<i4").tobytes() for t, i in words.special.items()}
        names = sorted(map(regex.escape, words.special), key=len, reverse=True)
        self.cut = regex.compile(f"({'|'.join(names) or '(?!)'})")
        self.plain = regex.compile(WORDS)
        later = _class(LATER_CLASSES)
        self.later = regex.compile(
            rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--[{later}]]+|[\p{{N}}--[{later}]]|[[^\s\p{{L}}\p{{N}}]||[{later}]]+"
        )
        self.rare = re.compile(f"[{later}{_class(LATER_MARKS)}{_class(LATER_CAPITALS)}]")
        self.marks = regex.compile(f"([{_class(LATER_MARKS)}])")
        self.capitals = {c: c + d for a, b, d in LATER_CAPITALS for c in range(a, b + 1)}

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if text.isascii():
            return self.plain.findall(text.lower())
        rare = self.rare.search(text) is not None
        if rare:
            text = "".join(unicodedata.normalize("NFC", t) for t in self.marks.split(text))
            text = text.translate(self.capitals)
        else:
            text = unicodedata.normalize("NFC", text)
        # Every character by itself: no form of sigma for the end of a word.
        text = text.replace("Σ", "σ").lower()
        return (self.later if rare else self.plain).findall(text)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, each as four bytes, the lowest first."""
        if len(self.cache) > self.most:
            self.cache.clear()
        look_up = self.cache.__getitem__
        if "<" not in text and all("<" in t for t in self.special):
            return b"".join(map(look_up, self.words(text)))
        out = []
        for part in self.cut.split(text):
            special = self.special.get(part)
            out.append(b"".join(map(look_up, self.words(part))) if special is None else special)
        return b"".join(out)


_encoders: dict[object, Encoder] = {}


def _encoder(key: object, held, most_words: int) -> Encoder:
    """This Python process's encoder: tasks that run in it one after another share its cache."""
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(Vocabulary(*held.value), most_words)
    return _encoders[key]


def decode(ids: list[int], tokens: list[str]) -> str:
    return " ".join(map(tokens.__getitem__, ids))


def _decoded(ids: pa.ListArray, tokens: pa.Array) -> pa.Array:
    """``decode`` of every row; an id outside the vocabulary is an error."""
    strings = tokens.take(ids.values)
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, strings), " ")


def _texts(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """The rows of a batch in bounded pieces: begin, end and texts."""
    for piece in pieces(column):
        raw, at = piece.data.tobytes(), piece.offsets.tolist()
        yield piece.begin, piece.end, [raw[a:b].decode(errors="replace") for a, b in zip(at, at[1:])]


_CODED = "doc_id long, ids array<int>, packed binary"


def _coded(ids_of: pa.Array, coded: list[bytes]) -> list[pa.Array]:
    """``doc_id, ids, packed`` of the texts whose ids are ``coded``."""
    data = pa.py_buffer(b"".join(coded))
    ends = np.concatenate(([0], np.cumsum([len(c) for c in coded]))).astype(np.int32)
    ids = pa.Array.from_buffers(pa.int32(), int(ends[-1]) // 4, [None, data])
    packed = pa.Array.from_buffers(pa.binary(), len(coded), [None, pa.py_buffer(ends), data])
    return [ids_of, pa.ListArray.from_arrays(pa.array(ends // 4), ids), packed]


def encode_documents(
    docs: DataFrame,
    vocabulary_file: str,
    doc_id: str = "doc_id",
    text: str = "text",
    most_words: int = CACHE_WORDS,
) -> DataFrame:
    """``doc_id, ids, packed`` per row; ``packed`` is ``ids`` as little-endian 32-bit integers."""
    return _run(docs, vocabulary_file, doc_id, text, most_words, False)


def round_trip(
    docs: DataFrame,
    vocabulary_file: str,
    doc_id: str = "doc_id",
    text: str = "text",
    most_words: int = CACHE_WORDS,
) -> DataFrame:
    """``doc_id, ids, packed, decoded``: encoding, then decoding, in one Python process per task."""
    return _run(docs, vocabulary_file, doc_id, text, most_words, True)


def _run(docs, vocabulary_file, doc_id, text, most_words, decoded) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(tuple(load_vocabulary(vocabulary_file)))
    key = (uuid.uuid4().hex, most_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(key, held, most_words)
        tokens = pa.array(encoder.cache.words.tokens, pa.string())
        for batch in batches:
            for begin, end, texts in _texts(batch.column(1)):
                columns = _coded(batch.column(0).slice(begin, end - begin), list(map(encoder.encode, texts)))
                if decoded:
                    columns.append(_decoded(columns[1], tokens))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "packed", "decoded"][: len(columns)])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, _CODED + (", decoded string" if decoded else ""))


def decode_documents(encoded: DataFrame, vocabulary_file: str) -> DataFrame:
    """``doc_id, ids, decoded`` per row of ``encode_documents``. Null ids are none; an id that the
    vocabulary does not have is an error."""
    held = encoded.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary_file).tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = held.value
        for batch in batches:
            lists = batch.column(1)
            texts = [decode(ids, tokens) for ids in lists.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"]
            )

    rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def token_digests(coded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of ``round_trip``."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
