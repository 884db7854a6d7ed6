import random
from collections import Counter

import pytest

from ledgerloom.llm import suffix_dedup as op
from tests.llm.conftest import ODD, words


def brute(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    times = Counter(b[p : p + length] for _, b in data for p in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if times[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        edges = [k for k in range(len(b) + 1) if (k and gone[k - 1]) != (k < len(b) and gone[k])]
        runs = list(zip(edges[::2], edges[1::2]))
        out.append((i, len(b), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def check(df, rows, length=50, anchor=8, **how):
    found = op.remove_repeats(df, length=length, anchor=anchor, **how).collect()
    got = [(r.doc_id, r.n_bytes, [tuple(x) for x in r.removed], bytes(r.kept)) for r in found]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(brute(rows, length), key=key)


def corpus():
    rng = random.Random(21)
    passage = [" ".join(words(rng, 14)) for _ in range(6)]
    texts = []
    for _ in range(150):
        parts = [" ".join(words(rng, rng.randrange(1, 25))) for _ in range(3)]
        parts.insert(rng.randrange(3), rng.choice(passage)[rng.randrange(8) :])
        texts.append(" ".join(parts))
    texts += texts[:20] + ["é漢😀" * 9 + t for t in texts[:10]]
    texts += ["ab" * n for n in (24, 25, 26, 40, 300)] + ["a" * n for n in (49, 50, 51, 52, 120)]
    texts += ["word, " * 60, "x word, " + "word, " * 60 + "y", "abcdefg" * 30 + "z", "q" + "abcdefg" * 9]
    return list(enumerate(texts))


@pytest.mark.parametrize("how", [{}, {"batch_strings": 5}, {"crowd": 2}])
def test_against_brute_force(spark, how):
    rows = corpus()
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows, **how)


def test_long_texts_are_cut_in_steps(spark, monkeypatch):
    monkeypatch.setattr(op, "_STEP", 256)
    rows = corpus()
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)


def test_production_length(spark):
    rng = random.Random(22)
    block = " ".join(words(rng, 130))
    rows = [(i, " ".join(words(rng, 40)) + block[i : i + 398 + i] + " ".join(words(rng, 40))) for i in range(12)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, 400, 64)


def test_odd_rows(odd, none):
    check(odd, ODD, 400, 64)
    assert op.remove_repeats(none).count() == 0
