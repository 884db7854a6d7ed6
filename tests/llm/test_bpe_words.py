"""Word BPE against the tokenizers library, which the operator does not use."""

import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import bpe_words as B
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.registry import table

FILE = public_tokenizers.path("word_bpe_49k.json")
SURROGATES = range(0xD800, 0xE000)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def vocabulary():
    return B.load_vocabulary(FILE)


def ids_of(encoder, text):
    data = encoder.encode(text)
    return list(struct.unpack(f"<{len(data) // 4}I", data))


def test_every_code_point(library, vocabulary):
    encoder = B.Encoder(vocabulary)
    texts = [f"A{chr(c)}1{chr(c)}! {chr(c)}e\u0301" for c in range(0x110000) if c not in SURROGATES]
    coded = library.encode_batch(texts, add_special_tokens=False)
    wrong = [t for t, c in zip(texts, coded) if ids_of(encoder, t) != c.ids]
    assert not wrong


def test_random_texts_and_special_tokens(library, vocabulary):
    encoder, rng = B.Encoder(vocabulary, most_words=50), random.Random(3)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|", "'s", "'LL", "'", "ΑΣ", "İ", "ẞ", "\u0323", "\u0301", "ﬁ", "\u1df6", "\U00011935\U00011930", "\ua7ce", " \n\u3000", "12", "the", "漢字", "😀"]
    for _ in range(3_000):
        text = "".join(rng.choice(parts) if rng.random() < 0.7 else chr(rng.randrange(32, 0x250)) for _ in range(rng.randrange(12)))
        ids = ids_of(encoder, text)
        assert ids == library.encode(text, add_special_tokens=False).ids, text
        assert B.decode(ids, vocabulary.tokens) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("word", ["x" * 50_000, "ab" * 20_000, "'" * 999, "the" * 300])
def test_long_words(library, vocabulary, word):
    assert ids_of(B.Encoder(vocabulary), word) == library.encode(word, add_special_tokens=False).ids


def test_ties_merge_leftmost_first():
    words = B.Vocabulary([], [0] * 256, [0] * 256, {0: 1, 1 << 24: 2 << 24 | 2}, {})
    assert list(B.merge(b"aaa", words)) == [2]  # (0 0) 0 -> 1 0 -> 2


def digests(library, doc_id, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    packed = struct.pack(f"<{len(ids)}I", *ids)
    return doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_query_equals_library(spark, library):
    folder = "/root/testdata/sf0.01"
    rows = table(spark, folder, "documents").select("doc_id", "text").collect()
    got = QUERIES["op13_word_bpe"](spark, folder)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(digests(library, *r) for r in rows)


def test_odd_rows(odd, library):
    rows = odd.select("doc_id", "text").collect()
    got = B.token_digests(B.round_trip(odd, FILE)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((digests(library, *r) for r in rows), key=repr)


def test_decoding_alone(odd):
    both = {r.doc_id: r.decoded for r in B.round_trip(odd.where("doc_id < 8"), FILE).collect()}
    alone = B.decode_documents(B.encode_documents(odd.where("doc_id < 8"), FILE), FILE)
    assert {r.doc_id: r.decoded for r in alone.collect()} == both


def test_bytes_that_are_not_utf8(spark, library):
    df = spark.createDataFrame([(1, bytearray(b"a\xffb"))], "doc_id long, text binary")
    df = df.selectExpr("doc_id", "cast(text AS string) AS text")
    assert B.round_trip(df, FILE).first().ids == library.encode("a\ufffdb", add_special_tokens=False).ids


def test_empty_table(none):
    assert B.round_trip(none, FILE).collect() == []


def test_decoding_takes_strings_for_all_ids_at_once(vocabulary):
    rng = random.Random(5)
    ids = [[rng.randrange(len(vocabulary.tokens)) for _ in range(rng.choice([0, 1, 3, 2_000]))] for _ in range(400)]
    packed = [np.array(i, "<i4").tobytes() for i in ids]
    lists = B._coded(pa.array(range(len(ids))), packed)[1]
    tokens = pa.array(vocabulary.tokens, pa.string())
    assert B._decoded(lists, tokens).to_pylist() == [B.decode(i, vocabulary.tokens) for i in ids]
    with pytest.raises(pa.ArrowIndexError):
        B._decoded(pa.array([[len(vocabulary.tokens)]], pa.list_(pa.int32())), tokens)
