import base64
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from ledgerloom.llm import bpe
from ledgerloom.llm.words import pieces
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.load_vocabulary(PATH), most_pieces=500)


def encode(encoder, texts):
    out = []
    for piece in pieces(pa.array(texts, pa.string()), most=3000):
        ids, _, first = encoder.encode(piece)
        out += [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
    return out


def test_random_texts(encoder, reference):
    rng = random.Random(1)
    alphabet = "' 'strevlmdS ELa9.\n\t \u3000é!,½\u200b\u0085漢😀\x1c<|>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(5000)]
    texts += [None, "", "'re", "'r", "'l", "'ll'", "<|endoftext|>", "a" * 3000, "ab" * 9000, " " * 5000, "x" + " " * 70 + "y"]
    assert encode(encoder, texts) == [reference.encode_ordinary(t or "") for t in texts]


def test_every_code_point(encoder, reference):
    texts = [f"a{chr(c)}b {chr(c)}1" for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    assert encode(encoder, texts) == [reference.encode_ordinary(t) for t in texts]


def test_round_trip(odd, reference):
    encoded = bpe.encode_documents(odd, PATH)
    two_steps = bpe.decode_documents(encoded, PATH).collect()
    key = lambda r: (str(r.doc_id), r.ids)
    assert sorted(two_steps, key=key) == sorted(bpe.round_trip(odd, PATH).collect(), key=key)
    want = sorted(((str(i), reference.encode_ordinary(t or ""), (t or "").encode()) for i, t in ODD))
    assert sorted((str(r.doc_id), r.ids, bytes(r.decoded)) for r in two_steps) == want
    for r in encoded.collect():
        size = [len(reference.decode_single_token_bytes(i)) for i in r.ids]
        assert r.offsets == [sum(size[:k]) for k in range(len(size))]


def test_empty(none):
    assert bpe.token_digests(bpe.round_trip(none, PATH)).count() == 0
