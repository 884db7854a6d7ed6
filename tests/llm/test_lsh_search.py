import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.lsh_search import exact_best, nearest
from ledgerloom.llm.registry import table

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, step, k=5):
    rows = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in rows:
        if q % step == 0:
            found = set()
            for i, b in rows:
                if i != q:
                    dot = sum(x * y for x, y in zip(a, b))
                    found.add((-dot / math.hypot(*a) / math.hypot(*b), i))
            out[q] = [(i, -s) for s, i in sorted(found, key=lambda x: (round(x[0], 12), x[1]))[:k]]
    return out


def run(df, step, **how):
    out = {}
    for r in nearest(df, F.col("vec_id") % step == 0, **how).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for found in out.values():
        assert [r for r, _, _ in found] == list(range(1, len(found) + 1))
    return {q: [(i, s) for _, i, s in found] for q, found in out.items()}


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-12)


def test_recall(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    place = {i: k for k, (i, _) in enumerate(rows)}
    got, hits, total = run(df, 50), 0, 0
    for q, found in got.items():
        near = unit @ unit[place[q]]
        near[place[q]] = -2
        best = {rows[k][0] for k in np.argsort(-near)[:5]}
        hits, total = hits + len(best & {i for i, _ in found}), total + 5
        assert all(s == pytest.approx(near[place[i]], abs=1e-12) for i, s in found)
    assert len(got) == sum(i % 50 == 0 for i, _ in rows) and hits / total >= 0.9


def test_recall_among_copies(spark):
    """Production parameters; 60% of the rows in clusters of near copies, the others in loose ones."""
    rng = np.random.default_rng(5)
    n, d, size = 20_000, 64, 10
    middle = np.repeat(rng.normal(size=(n // size, d)), size, axis=0)
    tight = np.arange(n) < 0.6 * n
    x = middle + rng.normal(size=(n, d)) * np.where(tight, 0.05, 0.8)[:, None]
    ids = rng.permutation(n)
    got = run(spark.createDataFrame([(int(i), v.tolist(), 1) for i, v in zip(ids, x)], SCHEMA), 50)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    hits = {True: [], False: []}
    for row in np.flatnonzero(ids % 50 == 0):
        near = unit @ unit[row]
        near[row] = -2
        best = {int(i) for i in ids[np.argsort(-near)[:5]]}
        hits[bool(tight[row])].append(len(best & {i for i, _ in got[int(ids[row])]}) / 5)
    print("recall", {kind: np.mean(h) for kind, h in hits.items()})
    assert all(np.mean(h) >= 0.9 for h in hits.values())


def test_copies_ties_and_invalid_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, -1.0]) for i in range(60)] + [(i, rng.normal(size=3).tolist()) for i in range(60, 120)]
    rows += [(130, None), (131, []), (132, [0.0] * 3), (133, [1.0, None, 1.0]), (134, [1.0, float("nan"), 0.0])]
    rows += [(135, [float("inf"), 0.0, 0.0]), (None, [1.0, 2.0, 3.0]), (61, rows[61][1]), (140, [1e200, 2e200, -1e200])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows] + [(150, [1.0, 2.0], 1)], SCHEMA).repartition(3)
    same(run(df, 20, success=1.0, block_rows=16), brute(rows, 20))


@pytest.mark.parametrize("times", [2, 5])
def test_repeated_rows(spark, times):
    """Rows that all stand several times are one candidate each; so is an id with several vectors."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(80)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows for _ in range(times)], SCHEMA).repartition(3)
    same(run(df, 20, success=1.0), brute(rows, 20))
    ids = np.repeat(np.arange(1, 9), times)
    x = np.array([[1.0, 0.1 * i + 1e-3 * j] for i in range(1, 9) for j in range(times)])
    _, found, _ = exact_best(ids, x, np.array([0]), np.array([[1.0, 0.0]]), 5)
    assert found.tolist() == [1, 2, 3, 4, 5]


def test_fewer_candidates_than_asked(spark):
    rows = [(0, [1.0, 0.0]), (1, [-1.0, 0.1]), (2, [0.0, 1.0]), (3, [0.5, -1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    same(run(df, 2), brute(rows, 2))
    same(run(df.where("vec_id = 0"), 2), {})
    assert nearest(df.limit(0), F.col("vec_id") % 2 == 0).count() == 0
