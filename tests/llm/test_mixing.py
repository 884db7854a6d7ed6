import random
import re

import pytest

from ledgerloom.llm import mixing as op
from tests.llm.conftest import ODD, words


def targets(size_of):
    """Targets by the rule as it is written: share, cut at three times, share the rest again."""
    names = sorted((s for s in size_of if s is not None)) + [None] * (None in size_of)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(size_of.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 3 * size_of[s]]
        if not over:
            return {**share, **capped}
        capped.update({s: 3.0 * size_of[s] for s in over})


@pytest.mark.parametrize("block_rows", [40, 1000])
def test_targets_and_totals(spark, block_rows):
    rng = random.Random(8)
    rows = []
    for i in range(1500):
        source = rng.choice(["a"] * 6 + ["b", "c", "d", "é", None, "tiny"][: 5 + (i < 30)])
        rows.append((i, " ".join(words(rng, rng.randrange(60))), source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = op.mix_sources(docs.repartition(5), block_rows=block_rows).collect()
    again = op.mix_sources(docs.repartition(3), block_rows=block_rows).collect()
    key = lambda r: r.doc_id
    assert sorted(found, key=key) == sorted(again, key=key)
    assert {r.doc_id: r["size"] for r in found} == {i: len(t.split()) for i, t, _ in rows}
    size_of, taken = {}, {}
    for r in found:
        size_of[r.source] = size_of.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert r.taken == r.repeats * r["size"] and 0 <= r.repeats <= 3
    want = targets(size_of)
    for r in found:
        assert r.source_size == size_of[r.source] and r.target == pytest.approx(want[r.source])
    for s, goal in want.items():
        assert abs(taken[s] - goal) <= max(3, 0.02 * goal), (s, taken[s], goal)
    # The document total is balanced as well.
    for s in ("a", "b"):
        own = [r for r in found if r.source == s]
        assert abs(sum(r.repeats for r in own) - len(own) * want[s] / size_of[s]) <= 2


def test_flight_keeps_both_totals():
    rng = random.Random(2)
    size = [float(rng.randrange(100)) for _ in range(200)]
    coin = [rng.random() for _ in size]
    out = op.flight(size, [0.37] * 200, coin, land=False)
    assert sum(0 < x < 1 for x in out) <= 2
    assert sum(out) == pytest.approx(74) and sum(s * x for s, x in zip(size, out)) == pytest.approx(0.37 * sum(size))


def test_chances_hold_on_average():
    rng = random.Random(5)
    size = [float(rng.randrange(1, 50)) for _ in range(30)]
    hits = [0.0] * 30
    for _ in range(3000):
        for i, x in enumerate(op.flight(size, [0.3] * 30, [rng.random() for _ in size], land=False)):
            hits[i] += x
    assert all(abs(h / 3000 - 0.3) < 0.05 for h in hits)


def test_odd_rows(odd, none):
    found = op.mix_sources(odd).collect()
    assert len(found) == len(ODD)
    counts = sorted(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in ODD)
    assert sorted(r["size"] for r in found) == counts
    assert sum(r.taken for r in found) == pytest.approx(sum(counts), abs=1)
    mixed = op.mixed_documents(odd, op.mix_sources(odd))
    assert mixed.columns == odd.columns
    assert op.mix_sources(none).count() == 0 and op.mixed_documents(none, op.mix_sources(none)).count() == 0


def test_no_words_at_all(spark):
    docs = spark.createDataFrame([(1, "", "a"), (2, None, "b")], "doc_id long, text string, source string")
    assert {(r.target, r.taken) for r in op.mix_sources(docs).collect()} == {(0.0, 0)}


def test_written_words_are_the_mix(spark):
    rng = random.Random(11)
    rows = [(i % 7 if i % 5 else None, " ".join(["w"] * rng.choice([0, 1, 3, 3, 50])), "ab"[i % 3 == 0]) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    mix = op.mix_sources(docs)
    written = op.mixed_documents(docs, mix).collect()
    mix = mix.collect()
    assert len({(r.doc_id, r["size"], r.source) for r in mix}) < len(mix)
    assert len(written) == sum(r.repeats for r in mix)
    for s in "ab":
        words_written = sum(len(r.text.split()) for r in written if r.source == s)
        assert words_written == sum(r.taken for r in mix if r.source == s)
    own = {(d, t, s) for d, t, s in rows}
    assert {tuple(r) for r in written} <= own


def test_ids_on_different_texts(spark):
    rows = [(1, "a b c d e f g h", "x"), (1, "a", "x"), (1, None, "x"), (None, "a b", "y"), (None, "c d e", "y"), (2, "q " * 30, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = op.mix_sources(docs)
    written = sum(len((r.text or "").split()) for r in op.mixed_documents(docs, mix).collect())
    assert written == sum(r.taken for r in mix.collect())


def test_targets_of_many_sources(spark):
    """Each source's cap is met at a level of its own, against filling up one source after another."""
    rng = random.Random(5)
    sizes = {f"s{i:03}": int(1.05**i) + rng.randrange(3) for i in range(300)} | {"z\U0001f600": 40, "z￮": 7, None: 90}
    rows = [(i, s, x) for i, (s, x) in enumerate(sizes.items())]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(5)
    found = {r.source: r.target for r in op.source_targets(df).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, shares, targets = sum(sizes.values()), sum(weight.values()), {}
    for s in sorted(order, key=lambda s: 3 * sizes[s] / weight[s]):
        targets[s] = min(3 * sizes[s], weight[s] * left / shares)
        left, shares = left - targets[s], shares - weight[s]
    assert all(abs(found[s] - targets[s]) <= 1e-9 * targets[s] for s in order) and len(found) == len(order)
    assert 0 < sum(targets[s] == 3 * sizes[s] for s in order) < len(order)
