import random

import numpy as np
import pytest

from ledgerloom.operators import dedup, large_sets
from tests.test_dedup import greedy, kept, near_copies


def texts(seed, n, groups, common=60):
    """Long texts with common words; some are near copies of others, borderline ones too."""
    rnd = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"c{rnd.randrange(common)}" for _ in range(30)] + [f"g{g}x{i}" for i in range(rnd.choice([20, 90, 200, 500]))]
        for _ in range(n // groups):
            words = list(base)
            for i in rnd.sample(range(len(words)), int(rnd.choice([0, 0.02, 0.1, 0.15, 0.2, 0.3]) * len(words))):
                words[i] = f"z{rnd.randrange(10**6)}" if rnd.random() < 0.7 else f"c{rnd.randrange(common)}"
            if rnd.random() < 0.3:
                words = words[: int(len(words) * rnd.uniform(0.6, 1))]
            rows.append(" ".join(words))
    rows += [" ".join(f"s{rnd.randrange(9)}" for _ in range(rnd.randrange(1, 9))) for _ in range(20)] + ["", None, rows[0].upper(), rows[-1]]
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("threshold", [0.5, 0.7, 0.9])
def test_large_sets_equal_the_greedy_loop(spark, threshold):
    rows = texts(5, 160, 12)
    df = spark.createDataFrame(rows, "ord long, title string").repartition(3)
    assert dedup._kept_at_once(df, threshold, "title", "ord") is not None
    out = dedup.remove_near_duplicates(df, threshold)
    assert sorted(r.ord for r in out.collect()) == greedy([(i, t or "") for i, t in rows], threshold)


def test_similar_sets_share_a_key_and_first_meetings_are_enough():
    """Sets just above the threshold share a key that follows another one, for any sizes; unlike ones do not."""
    rng = np.random.default_rng(6)
    for n in (1, 3, 20, 47, 48, 60, 97, 130, 192, 400, 900):
        for grow in (0, 0.2, 0.4):
            base = np.unique(rng.integers(1, 2**64, n, dtype=np.uint64))
            more = rng.integers(1, 2**64, int(grow * n), dtype=np.uint64)
            rank = {int(w): i for i, w in enumerate(rng.permutation(np.concatenate((base, more))))}
            other = np.concatenate((base, more))
            if len(base) / len(other) <= 0.7:
                continue
            found = []
            for words in (base, other):
                ranked = np.array(sorted(words.tolist(), key=rank.get), np.uint64)
                found.append(dict(zip(*(x.tolist() for x in large_sets.keys(ranked, 0.7)))))
            shared = found[0].keys() & found[1].keys()
            assert any(not found[0][k] or found[0][k] != found[1][k] for k in shared), (n, grow)


def test_texts_that_share_words_by_chance_do_not_meet(spark):
    """Every two share some words out of their rarest; before, they met under single words."""
    rnd = random.Random(7)
    rows = [(i, " ".join([*(f"r{rnd.randrange(400)}" for _ in range(12)), *(f"o{i}x{j}" for j in range(150))])) for i in range(300)]
    df = spark.createDataFrame(rows + [(900, rows[3][1] + " more")], "ord long, title string")
    hashed = large_sets._hashed(df, "title", "ord")
    _, sketch = large_sets._signatures(hashed)
    met = large_sets._entries(hashed, sketch, 0.7).groupBy("bucket").applyInArrow(large_sets._met(9), "a long, b long")
    assert met.distinct().count() <= 300
    sets, possible = large_sets.possible_pairs(df, "title", "ord", 0.7)
    assert sets.count() == 301 and [tuple(r) for r in possible.collect()] == [(3, 900)]


def test_what_goes_by_leaders(spark, monkeypatch):
    """Small sets, repeated orders, large groups of near copies."""
    rows = texts(8, 60, 3)
    frame = lambda x: spark.createDataFrame(x, "ord long, title string")
    assert large_sets.possible_pairs(frame(near_copies(30)), "title", "ord", 0.7) is None
    assert large_sets.possible_pairs(frame(rows + rows[:1]), "title", "ord", 0.7) is None
    monkeypatch.setattr(large_sets, "CROWDED", 5)
    assert large_sets.possible_pairs(frame(rows), "title", "ord", 0.7) is None
    assert kept(spark, [(i, t or "") for i, t in rows], 0.7) == greedy([(i, t or "") for i, t in rows], 0.7)


def test_chains_beyond_the_rounds_by_heads(spark, monkeypatch):
    monkeypatch.setattr(large_sets, "LAZY_ROUNDS", 1)
    rows = [(i, " ".join(f"t{j}" for j in range(12 * i, 12 * i + 100))) for i in range(14)]
    assert kept(spark, rows, 0.7) == greedy(rows, 0.7)
