"""Hashes of words: texts that agree modulo 2^64 for every odd base, long texts, and plain arithmetic."""

import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import words as W
from ledgerloom.llm.jaccard_join import similarity_classes
from ledgerloom.llm.line_dedup import remove_aligned_lines


def thue_morse(n, letters="ab"):
    return "".join(letters[bin(i).count("1") & 1] for i in range(n))


def hashes(texts):
    piece = next(W.pieces(pa.array(texts), 1 << 40))
    return W.Hasher().ranges(piece.data, piece.offsets[:-1], piece.offsets[1:])


@pytest.mark.parametrize("n", [1024, 4096])
def test_thue_morse_words_differ(n):
    one, other = hashes([thue_morse(n), thue_morse(n, "ba")])
    assert one != other


def test_products_modulo_the_prime():
    rng = random.Random(1)
    x = [rng.randrange(W.PRIME) for _ in range(500)] + [0, 1, W.PRIME - 1, W.PRIME - 1]
    y = [rng.randrange(W.PRIME) for _ in range(500)] + [5, W.PRIME - 1, W.PRIME - 1, 2]
    got = W.times(np.array(x, np.uint64), np.array(y, np.uint64))
    assert got.tolist() == [a * b % W.PRIME for a, b in zip(x, y)]


def test_sums_of_many_segments(monkeypatch):
    data = np.random.default_rng(2).integers(0, 256, 5_000).astype(np.uint8)
    starts = np.arange(0, 4_900, 7)
    whole = W.Hasher().ranges(data, starts, starts + 50)
    monkeypatch.setattr(W, "_SEGMENT", 64)
    assert np.array_equal(W.Hasher().ranges(data, starts, starts + 50), whole)
    alone = [W.Hasher().ranges(data[s : s + 50], np.array([0]), np.array([50]))[0] for s in starts[:20]]
    assert whole[:20].tolist() == alone


def test_equal_only_if_equal():
    rng = random.Random(3)
    texts = list({"".join(rng.choice("ab\x00") for _ in range(rng.randrange(1, 9))) for _ in range(3_000)})
    assert len(set(hashes(texts).tolist())) == len(texts)


@pytest.mark.parametrize("n", [1024, 4096])
def test_operators_tell_such_words_apart(frame, n):
    one, other = thue_morse(n), thue_morse(n, "ba")
    rows = similarity_classes(frame([one, other])).collect()
    assert {r.component_id for r in rows} == {0, 1}
    line = " ".join([one] * 5), " ".join([other] * 5)
    kept = remove_aligned_lines(frame([f"x\n{line[0]}", f"y\n{line[1]}"])).collect()
    assert all(r.n_removed == 0 for r in kept)
