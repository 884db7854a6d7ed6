"""The trie of rebuilt conversations against a trie that is written out."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import prefix_trie as P

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(ts, key=lambda x: (x[0], x[1], x[2].encode(), x[3].encode()))] for c, ts in turns.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])
        rebuilt[c] = tuple(base[:h] + own[c][h:])
    members = defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        leaves = 0 if children[node] else 1
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        for child in children[node]:
            leaves, saved = leaves + sums[child][0], saved + sums[child][1]
        sums[node] = leaves, saved
    out = []
    for node, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(rebuilt[c]) == len(node))
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(children[node]), *sums[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def found(spark, rows):
    got = P.prefix_trie(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()))


def random_rows(seed, conversations=150, step=3):
    rng, rows = random.Random(seed), []
    for i in range(conversations):
        c = i * step
        for turn in range(rng.randrange(1, 9)):
            rows.append((c, rng.choice([turn, turn, 1, None]), rng.choice(["user", "user", None, ""]), rng.choice(["a", "b", "", None, "é😀", "user"])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    rows = random_rows(seed) + [(None, 1, "user", "left out"), (-7, 0, "user", "a"), (-100, 0, "user", "b")]
    assert found(spark, rows) == brute(rows)


def test_turnless_and_absent_bases(spark):
    rows = [(c, 0, "user", "only") for c in range(201, 240)]  # no base: heads are empty
    rows += [(c, 0, "user", "only") for c in range(300, 320)]  # one turn of the base, own ones gone
    assert any(zlib.crc32(str(r[0]).encode()) % 6 for r in rows)
    got = found(spark, rows)
    assert got == brute(rows)
    assert got[0][:3] == (201, 0, None)


def test_long_conversations_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 7)
    rows = [(c, t, "user", "same" if t < 60 else f"{c}-{t}") for c in (1, 2, 3) for t in range(90)]
    rows += [(c, t, "user", "same") for c in (4, 5) for t in range(40)] + [(6, t, None, "x" * 5_000) for t in range(15)]
    assert found(spark, rows) == brute(rows)


def test_many_copies(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(P.BLOCK + 500) for t in range(1)]
    assert found(spark, rows) == brute(rows)


def test_clashing_keys_are_found_and_replaced(spark, monkeypatch):
    keys, salts = P.turn_keys, []

    def weak(role, text, salt):
        salts.append(salt)
        if salt == 0:  # different texts share a key
            return [F.length(text).cast("long")] * 4
        return keys(role, text, salt)

    monkeypatch.setattr(P, "turn_keys", weak)
    rows = random_rows(5, 40)
    assert found(spark, rows) == brute(rows)
    assert salts == [0, 1]


def test_products_that_agree_by_chance_are_found(spark):
    columns = "conv_id long, depth long, f1 long, f2 long, p1 long, p2 long, k1 long, k2 long, n_chars long"
    good = [(1, 1, 5, 5, 0, 0, 7, 7, 1), (2, 1, 5, 5, 0, 0, 7, 7, 1)]
    for change in (4, 6, 8):
        bad = list(good[1])
        bad[change] += 1
        assert P._nodes(spark.createDataFrame(good, columns))[1]
        assert not P._nodes(spark.createDataFrame([good[0], tuple(bad)], columns))[1]


def test_composition_is_associative():
    rng = random.Random(4)
    f, g, h = (P._as_map(tuple(rng.randrange(2**60) for _ in range(4))) for _ in range(3))
    assert P._then(P._then(f, g), h) == P._then(f, P._then(g, h))
    assert P._then(f, g) != P._then(g, f)
    assert P._then(P.ONE, f) == f == P._then(f, P.ONE)


def test_clashing_names_and_empty_tables(spark):
    rows = random_rows(9, 30)
    df = spark.createDataFrame(rows, "id long, n long, who string, what string")
    for name in ("conv_id", "depth", "f1", "idx", "n_chars", "k1", "first", "items", "turn"):
        df = df.withColumn(name, F.lit("x"))
    got = P.prefix_trie(df, "id", "n", "who", "what")
    assert sorted(map(tuple, got.collect())) == brute(rows)
    assert P.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert P.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).collect() == []
