import random

import pytest

from ledgerloom.operators import dedup


def greedy(rows, threshold):
    kept, out = [], []
    for order, text in sorted(rows):
        words = set(text.lower().split())
        similar = any(words and k and len(words & k) / len(words | k) > threshold for k in kept)
        if not similar:
            kept.append(words)
            out.append(order)
    return out


def kept(spark, rows, threshold, **tuning):
    df = spark.createDataFrame(rows, "ord long, title string")
    out = dedup.remove_near_duplicates(df, threshold, **tuning)
    return sorted(r.ord for r in out.select("ord").collect())


def random_rows(seed, n=250):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(rnd.choice([6, 20, 120]))]
    rows = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randint(0, 8)))) for i in range(n)]
    rnd.shuffle(rows)
    return rows


def near_copies(n, start=0, seed=0):
    rnd = random.Random(seed)
    base = [f"h{i}" for i in range(12)]
    rows = []
    for i in range(n):
        words = list(base)
        words[rnd.randrange(12)] = f"x{rnd.randrange(40)}"
        rows.append((start + i, " ".join(words)))
    return rows


def test_literal_case(spark):
    titles = ["a b c d", "A B C D", "a b c d e", "a b c d e f", "", "", "   ", None]
    assert kept(spark, list(enumerate(titles)), 0.7) == [0, 3, 4, 5, 6, 7]


@pytest.mark.parametrize("seed,threshold", [(1, 0.7), (2, 0.5), (3, 0.0), (4, 0.9), (5, 1 / 3)])
def test_equals_the_greedy_loop(spark, seed, threshold):
    rows = random_rows(seed)
    assert kept(spark, rows, threshold) == greedy(rows, threshold)


TIGHT = dict(fanout=1, first_leaders=1, small_group=3, max_group=5, hot=6)


@pytest.mark.parametrize("threshold", [0.7, 0.85])
def test_hot_group_of_near_copies_in_leader_rounds(spark, threshold):
    rows = random_rows(7, 200) + near_copies(120, 200)
    random.Random(1).shuffle(rows)
    assert kept(spark, rows, threshold, **TIGHT) == greedy(rows, threshold)


def test_hot_word_among_dissimilar_records(spark):
    rows = [(i, f"hot a{i} b{i}" if i % 2 else f"hot a{i - 1} b{i - 1} c{i}") for i in range(80)]
    assert kept(spark, rows, 0.5, **TIGHT) == greedy(rows, 0.5)


def test_leader_round_compares_linearly_many_pairs(spark):
    """In a group of n near-copies the first round looks at a few pairs per record, not n each."""
    n = 600
    df = spark.createDataFrame(near_copies(n), "ord long, title string")
    sets = dedup.word_sets(df, "title", "ord")
    postings = dedup._postings(sets, 0.7)
    assert not dedup._unrestricted(postings, 1, 20)
    from pyspark.sql import Window, functions as F

    rank = F.row_number().over(Window.partitionBy("word").orderBy("ord"))
    leaders = postings.withColumn("rank", rank).where("rank <= 2").drop("rank")
    pairs = dedup.similar_pairs(sets, postings, leaders, 0.7).count()
    assert pairs <= 2 * postings.count()


def test_chain_is_resolved_by_distributed_rounds(spark):
    rows = [(i, " ".join(f"t{j}" for j in range(i, i + 10))) for i in range(12)]
    assert kept(spark, rows, 0.7) == greedy(rows, 0.7)


def three_hot(n, seed=1):
    """Dissimilar records that share three hot words, beside one to eight of their own."""
    rnd = random.Random(seed)
    return [(i, "the of and " + " ".join(f"u{i}x{j}" for j in range(rnd.choice([1, 1, 2, 3, 8])))) for i in range(n)]


def few_words(n, seed=2):
    """Sets of eight out of sixty words, all of them hot, and hardly any two similar."""
    rnd = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(60)]
    return [(i, " ".join(rnd.sample(vocabulary, 8))) for i in range(n)]


@pytest.mark.parametrize("make", [three_hot, few_words])
@pytest.mark.parametrize("threshold", [0.7, 0.8])
def test_dissimilar_records_under_hot_words(spark, make, threshold):
    rows = make(500) + [(1_000, "the of and"), (1_001, "the of"), (1_002, "v1 v2 v3 v4 v5 v6 v7"), (1_003, "v1 v2 v3 v4 v5 v6 v7 v8")]
    assert kept(spark, rows, threshold, hot=20) == greedy(rows, threshold)


@pytest.mark.parametrize("make", [three_hot, few_words])
def test_work_under_hot_words_grows_with_the_rows(spark, make):
    from pyspark.sql import functions as F

    met, pairs = [], []
    for n in (1_000, 4_000):
        sets = dedup.word_sets(spark.createDataFrame(make(n), "ord long, title string"), "title", "ord", hot=100)
        postings = dedup._postings(sets, 0.7).cache()
        groups = postings.groupBy("word", F.coalesce("meets", "word").alias("meets")).count()
        others = groups.select(F.col("word").alias("meets"), F.col("count").alias("others"))
        met.append(groups.join(others, "meets").agg(F.sum(F.col("count") * F.col("others"))).first()[0])
        pairs.append(dedup.candidate_pairs(postings, postings, 0.7).count())
    if make is three_hot:
        assert met[1] <= 4**1.3 * met[0]
        assert pairs == [0, 0]
    else:  # so few words have chance meetings, but not those of plain words
        assert met[1] <= 4_000**2 / 200 and pairs[1] <= 4_000


def test_long_chain_in_few_rounds(spark):
    n = 5_000
    edges = spark.range(n - 1).selectExpr(
        "id AS a", "id + 1 AS b", "id AS a_ord", "id + 1 AS b_ord", "false AS a_waits", "false AS b_waits"
    )
    dropped, still_open = dedup.resolve(edges)
    assert len(dropped) <= 5 and still_open.isEmpty()
    gone = sorted(r.rid for part in dropped for r in part.collect())
    assert gone == list(range(1, n, 2))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_paths_among_other_links(spark, seed):
    """Random graphs in order, some of whose records wait for others outside the graph."""
    rnd = random.Random(seed)
    links = {(i, i + 1) for i in range(120) if rnd.random() < 0.9}
    links |= {tuple(sorted(rnd.sample(range(121), 2))) for _ in range(25)}
    waits = set(rnd.sample(range(121), 4)) if seed > 1 else set()
    rows = [(a, b, a, b, a in waits, b in waits) for a, b in sorted(links)]
    edges = spark.createDataFrame(rows, "a long, b long, a_ord long, b_ord long, a_waits boolean, b_waits boolean")
    dropped, still_open = dedup.resolve(edges, plain_rounds=0)
    plain, plain_open = dedup.resolve(edges, plain_rounds=10**9)
    ids = lambda parts: {r[0] for part in parts for r in part.collect()}
    assert ids(dropped) == ids(plain) and ids([still_open]) == ids([plain_open])
    before = {b: [a for a, x in links if x == b] for b in range(121)}
    state = {}
    for i in range(121):
        own = [state[a] for a in before[i]]
        state[i] = "dropped" if "kept" in own else "open" if "open" in own or i in waits else "kept"
    assert ids(dropped) == {i for i, x in state.items() if x == "dropped"}


def test_whole_texts_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    out = dedup.remove_near_duplicates(docs, 0.7, "text", "doc_id")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(r.doc_id for r in out.collect()) == greedy(rows, 0.7)


def test_counts_and_thresholds(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "b a"), (3, "c")], "ord long, title string")
    assert tuple(dedup.dedup_counts(dedup.duplicate_status(df, 0.7)).first()) == (3, 2, 1)
    assert dedup.remove_near_duplicates(df, 1.0).count() == 3
    with pytest.raises(ValueError):
        dedup.duplicate_status(df, -0.1)


def large_sets(n, size=1500):
    """Dissimilar sets that parity bits are too few for; any two share three rare words, under which they meet."""
    return [(i, " ".join([*(f"s{j}" for j in range(3)), *(f"w{i}_{j}" for j in range(size))])) for i in range(n)]


def test_large_sets_that_share_few_words_are_not_fetched(spark):
    df = spark.createDataFrame(large_sets(12) + [(99, large_sets(12)[3][1] + " more")], "ord long, title string")
    sets = dedup.word_sets(df, "title", "ord")
    postings = dedup._postings(sets, 0.7)
    met = dedup.candidate_pairs(postings, postings, 0.7)
    names = {r.rid: r.ord for r in sets.select("rid", "ord").collect()}
    assert [(names[r.a], names[r.b]) for r in met.collect()] == [(3, 99)]


@pytest.mark.parametrize("threshold", [0.3, 0.7, 0.9])
@pytest.mark.parametrize("tuning", [{}, TIGHT])
def test_sets_that_meet_under_several_words(spark, monkeypatch, threshold, tuning):
    monkeypatch.setattr(dedup, "WORDS_A_MEETING", 3)
    rnd = random.Random(11)
    bases = [[f"b{rnd.randrange(300)}" for _ in range(120)] for _ in range(4)]
    rows = []
    for i in range(120):
        words = set(bases[i % 4])
        for word in rnd.sample(sorted(words), rnd.randrange(0, 40)):
            words.remove(word)
            words.add(f"x{rnd.randrange(60)}" if rnd.random() < 0.5 else f"y{i}_{rnd.randrange(9)}")
        rows.append((i, " ".join(words)))
    assert kept(spark, rows, threshold, **tuning) == greedy(rows, threshold)
