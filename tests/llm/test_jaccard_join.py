import random
import re

import pytest

from ledgerloom.llm import graph, jaccard_join as op
from tests.llm.conftest import ODD, words


def shingles(text, width=4):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, least=85):
    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in rows if i is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1 :]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= least * len(a | b):
                x, y = sorted((top(i), top(j)))
                up[y] = x
    return [(i, len(s), None if i is None else top(i)) for i, s in sets]


def check(df, rows, **how):
    found = [tuple(r) for r in op.similarity_classes(df, **how).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(found, key=key) == sorted(brute(rows), key=key)


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block_rows", [16, 512])
def test_families_of_near_copies(spark, block_rows):
    """Borderline copies of one text, a text of which others are a part, a common passage."""
    rng = random.Random(11)
    passage = words(rng, 12)
    texts = near_copies(rng, words(rng, 120), 110, 3)
    texts += near_copies(rng, words(rng, 70), 30, 2)
    base = words(rng, 100)
    texts += [" ".join(base[: 60 + i]) for i in range(40)]
    texts += [" ".join([*passage, *words(rng, rng.randrange(5, 40))]) for _ in range(90)]
    texts += [" ".join(words(rng, rng.randrange(1, 30), 20)) for _ in range(60)]
    texts += texts[:50]
    rng.shuffle(texts)
    rows = list(enumerate(t.title() if i % 3 else t for i, t in enumerate(texts)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(df, rows, block_rows=block_rows)


def test_crowded_and_salted_columns(spark, monkeypatch):
    monkeypatch.setattr(op, "COLUMN_PAIRS", 3)
    monkeypatch.setattr(op, "SALTED_ENTRIES", 2)
    rng = random.Random(12)
    texts = near_copies(rng, words(rng, 60), 60, 2) + near_copies(rng, words(rng, 40), 25, 2)
    rows = list(enumerate(texts + [" ".join(words(rng, 20)) for _ in range(40)]))
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows, block_rows=20)


def test_odd_rows(odd, none):
    found = sorted(((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in op.similarity_classes(odd).collect()))
    assert found == sorted((str(i), n, str(c)) for i, n, c in brute(ODD))
    kept = op.keep_one_per_class(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, _, c in brute(ODD)}
    assert op.similarity_classes(none).count() == op.keep_one_per_class(none).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    order = rng.sample(range(1000), 300)
    edges = list(zip(order, order[1:])) + [(2000, x) for x in range(2001, 2200)] + [(5000, 5000)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in graph.components(df).collect()}
    assert found == {**{x: min(order) for x in order}, **{x: 2000 for x in range(2000, 2200)}}


def test_ids_on_several_texts(spark):
    rng = random.Random(8)
    a, b, c, d = (words(rng, 60, 9_000) for _ in range(4))
    near = lambda w: " ".join(w[:-1])
    rows = [(2, " ".join(a)), (2, " ".join(b)), (2, " ".join(c)), (1, near(a)), (3, near(b)), (4, near(c)), (5, " ".join(d)), (6, near(d))]
    rows += [(7, " ".join(d)), (7, ""), (8, None), (8, "one"), (9, "one"), (None, " ".join(a)), (2, " ".join(a))]
    for low in (0, 2**62):
        moved = [(i if i is None else i + low, t) for i, t in rows]
        docs = spark.createDataFrame(moved, "doc_id long, text string")
        got = op.similarity_classes(docs)
        assert got.columns == ["doc_id", "n_shingles", "component_id"]
        got = got.collect()
        assert len(got) == len(rows)
        found = {(r.doc_id - low, r.component_id - low) for r in got if r.doc_id is not None}
        assert found == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 5), (6, 5), (7, 5), (8, 8), (9, 8)}
        assert all(r.component_id is None for r in got if r.doc_id is None)
        sizes = sorted((r.doc_id - low, r.n_shingles) for r in got if r.doc_id is not None)
        assert sizes.count((2, 57)) == 4 and (7, 0) in sizes and (8, 0) in sizes


@pytest.mark.parametrize("pairs_a_column", [64, 3])
def test_chance_ngrams_make_no_family(spark, monkeypatch, pairs_a_column):
    """Texts of one size that share a rare passage each with the next, or all with all, but are unlike."""
    monkeypatch.setattr(op, "COLUMN_PAIRS", pairs_a_column)
    sizes, placed = [], op._placed
    monkeypatch.setattr(op, "_placed", lambda family, *how: sizes.append(family.count()) or placed(family, *how))
    rng = random.Random(21)
    passages = [words(rng, 4, 10**9) for _ in range(121)]
    hot = words(rng, 4, 10**9)
    texts = [" ".join([*passages[i], *words(rng, 60, 10**9), *passages[i + 1], *hot]) for i in range(120)]
    texts += [texts[7] + " more", texts[9], texts[9]]
    rows = list(enumerate(texts))
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)
    assert sizes == [2]


def test_members_of_a_column_of_many_sizes(spark, monkeypatch):
    """Sets whose parity has different widths, in crowded columns and in one too large to be looked at."""
    rng = random.Random(22)
    texts = []
    for n in (30, 250, 262, 500, 530, 1_050):
        base = words(rng, n, 10**6)
        texts += near_copies(rng, base, 8, 3) + [" ".join(base[: int(0.9 * n)])]
    hot = " ".join(words(rng, 5, 10**6))
    rows = list(enumerate(f"{hot} {t}" for t in texts))
    monkeypatch.setattr(op, "COLUMN_PAIRS", 2)
    for least in (85, 40):
        check_least = [tuple(r) for r in op.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string"), least=least).collect()]
        assert sorted(check_least) == sorted(brute(rows, least))
    monkeypatch.setattr(op, "VERIFIED_MEMBERS", 10)
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_family_texts_are_found_without_a_broadcast_of_rows(spark):
    rows = [(i * 2**20 - 5_000, f"w{i} a b c d") for i in range(400)] + [(None, "a b c d"), (2**63 - 1, "a b c d e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = [i for i, _ in rows[::7] if i is not None] + [2**63 - 1]
    nodes = spark.createDataFrame([(i, 2, i, 0, 0) for i in ids], "node long, n long, family long, band long, block long")
    sets = op._sets(docs, nodes, "doc_id", "text", 4)
    assert "Broadcast" not in sets._jdf.queryExecution().toString().replace("BroadcastMode", "")
    assert sorted(r.node for r in sets.collect()) == sorted(ids)
