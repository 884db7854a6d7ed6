import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates
from ledgerloom.operators import clean, index, lookup, profile, relations
from ledgerloom.plans import jobs
from ledgerloom.sinks import writers


@pytest.mark.parametrize(
    "values,bins",
    [
        ([1, 2, 3, 4, 10], 5),
        (list(range(0, 101, 5)), 20),
        ([7, 7, 7], 50),
        ([0.1 * i for i in range(31)], 30),
        (np.random.default_rng(1).integers(1, 90, 500).tolist(), 50),
    ],
)
def test_histogram_equals_numpy(spark, values, bins):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    rows = profile.histogram(df, F.col("v"), bins).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins)
    assert [r.n for r in rows] == counts.tolist()
    assert np.allclose([r.lo for r in rows] + [rows[-1].hi], edges)


def test_histogram_of_nothing_is_empty(spark):
    empty = spark.createDataFrame([(None,)], "v double")
    assert profile.histogram(empty, F.col("v"), 5).count() == 0


def test_label_distribution_gate(spark):
    df = spark.range(400).select(
        F.lit("one").alias("single"),
        F.format_string("%d", F.col("id") % 2).alias("two"),
        F.format_string("%d", F.col("id") % 99).alias("c99"),
        F.format_string("%d", F.col("id") % 100).alias("c100"),
        F.when(F.col("id") % 2 == 0, "x").alias("x or null"),
        F.format_string("%d", F.col("id")).alias("unique"),
        F.col("id"),
    )
    found = profile.label_distributions(df).groupBy("column").agg(F.count("*"), F.sum("n")).collect()
    assert {tuple(r) for r in found} == {("two", 2, 400), ("c99", 99, 400)}


def test_field_profile(spark):
    rows = [(1, None, "  "), (0, "ab", None), (2, "c" * 50, "")]
    df = spark.createDataFrame(rows, "ord int, title string, summary string")
    out = profile.field_profile(df, ["title", "summary"], F.col("ord")).collect()
    assert tuple(out[0]) == ("title", 3, 2, 2 / 3, 26.0, "ab")
    assert tuple(out[1]) == ("summary", 3, 0, 0.0, 0.0, "N/A")
    none = profile.field_profile(df.limit(0), ["title"]).collect()
    assert tuple(none[0]) == ("title", 0, 0, 0.0, 0.0)


def test_completeness_of_an_empty_corpus(spark):
    df = spark.createDataFrame([], "title string, published string, link string, category string")
    assert tuple(profile.completeness(df).first()) == (0, 0, 0.0, 0.0, False)


def test_most_common_breaks_ties_by_first_appearance(spark):
    df = spark.createDataFrame(list(enumerate("baabc")), "ord int, v string")
    top = profile.most_common(df, F.col("v"), F.col("ord"), 2)
    assert [tuple(r) for r in top.collect()] == [("b", 2), ("a", 2)]


def test_shares(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "v string")
    rows = profile.with_share(profile.frequencies(df, F.col("v"))).collect()
    assert {(r.value, r.pct) for r in rows} == {("a", 50.0), ("b", 25.0), ("c", 25.0)}


def test_ideal_use_takes_the_last_key(spark):
    names = ["boe_cls_x", "boe", "nothing", "xrnsx"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(lookup.ideal_use(F.col("n"))).collect()]
    uses = lookup.IDEAL_USES
    assert got == [uses["boe_cls"], uses["boe"], None, uses["rns"]]


def test_clean_companies(spark):
    rows = [("A", "1/1/1900"), ("B", "31/12/1899"), ("C", "2/1/2024"), ("D", "3/1/2024"), ("", "1/1/2000"), (None, "1/1/2000")]
    df = spark.createDataFrame(rows, "CompanyName string, IncorporationDate string")
    kept = clean.clean_companies(df, as_of="2024-01-02").orderBy("CompanyName").collect()
    named = [("A", "1900-01-01", "ch"), ("C", "2024-01-02", "ch")]
    assert [(r.CompanyName, r.date, r.source) for r in kept] == [*named, ("nan", "2000-01-01", "ch")]
    kept = clean.clean_companies(df, as_of="2024-01-02", null_name=None).orderBy("CompanyName").collect()
    assert [(r.CompanyName, r.date, r.source) for r in kept] == named
    bare = clean.clean_companies(spark.createDataFrame([("x",)], "other string")).first()
    assert (bare.other, bare.date, bare.source) == ("x", None, "ch")


def test_line_numbers_with_tiny_splits(spark, tmp_path):
    lines = {f"f{k}": [f"{k}-{i}" + "." * (i % 50) for i in range(900)] for k in range(3)}
    for name, rows in lines.items():
        (tmp_path / name).write_text("\n".join(rows) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = index.numbered_lines(spark, str(tmp_path))
        got = {(r.file.rsplit("/", 1)[-1], r.line_no): r.value for r in df.collect()}
        assert got == {(name, i): v for name, rows in lines.items() for i, v in enumerate(rows)}
        whole = index.numbered_lines(spark, str(tmp_path), per_file=False).orderBy("line_no").collect()
        assert [r.value for r in whole] == [v for rows in lines.values() for v in rows]
        assert [r.line_no for r in whole] == list(range(2700))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_shards_of_ten_rows(spark, tmp_path):
    out = writers.write_shards(spark.range(10), str(tmp_path / "s"), 4, order_by=["id"])
    rows = spark.read.parquet(out).collect()
    assert {r.id: r.part for r in rows} == {i: f"part_{i // 4:05d}" for i in range(10)}
    with pytest.raises(ValueError):
        writers.write_shards(spark.range(1), str(tmp_path / "t"))


def test_relations(spark, tmp_path):
    (tmp_path / "dev.sent").write_text("First  sentence .\nSecond one\nThird\nSurplus\n")
    (tmp_path / "dev.tup").write_text("X ; Y ; owner_of | bad ; row | X ; Z ; unknown\n\n A;B;owner_of|\n")
    (tmp_path / "relations.txt").write_text(" owner_of \n\nother\n")
    rows = relations.load_relations(spark, "dev", str(tmp_path)).orderBy("sent_id").collect()
    assert [(list(r.tokens), r.head_text, r.tail_text, r.relation, r.sent_id) for r in rows] == [
        (["First", "sentence", "."], "X", "Y", "owner_of", 0), (["Third"], "A", "B", "owner_of", 2)
    ]
    pairs = relations.pair_lines(
        index.numbered_lines(spark, str(tmp_path / "dev.sent")), index.numbered_lines(spark, str(tmp_path / "dev.tup"))
    )
    valid = spark.createDataFrame([("owner_of",)], "relation string")
    rejected = relations.rejected_triples(pairs, valid).orderBy("sent_id", "triple").collect()
    assert [tuple(r) for r in rejected] == [
        (0, "X ; Z ; unknown", "unknown relation"), (0, "bad ; row", "malformed"), (2, "", "malformed")
    ]


def test_a_triple_line_without_a_sentence_is_an_error(spark, tmp_path):
    (tmp_path / "x.sent").write_text("one\n")
    (tmp_path / "x.tup").write_text("a;b;c\na;b;c\n")
    (tmp_path / "relations.txt").write_text("c\n")
    with pytest.raises(Exception, match="no sentence for line"):
        relations.load_relations(spark, "x", str(tmp_path)).collect()


def test_announcement_eda(spark):
    rows = [
        (0, "Final results", "2024-01-02T03:04:05", "s" * 201, "rns", "A", "S", "https://x.org/1"),
        (1, "", "Tue, 03 Jan 2024 05:00:00 GMT", "", None, "A", "S", "/local"),
        (2, "Third", "junk", None, " ", "B", None, "http://y.org"),
    ]
    df = spark.createDataFrame(
        rows, "ord long, title string, published string, summary string, category string, author string, source string, link string"
    )
    eda = jobs.announcement_eda(df, samples=2)
    assert tuple(eda["parse_rate"].first()) == (2, 3, 2 / 3)
    assert eda["date_range"].first().span_days == 1
    assert {r.hour for r in eda["per_hour"].collect()} == {3, 5}
    assert [r.n for r in eda["formats"].collect()] == [1, 1]
    assert [tuple(r) for r in eda["domains"].collect()] == [("x.org", 1), ("y.org", 1)]
    assert [tuple(r) for r in eda["categories"].collect()] == [("rns", 1), ("Unknown", 1), (" ", 1)]
    assert {(r.source, r.n) for r in eda["sources"].collect()} == {("S", 2), ("unknown", 1)}
    assert tuple(eda["completeness"].first())[:2] == (3, 2)
    samples = eda["samples"].collect()
    assert samples[0].summary == "s" * 200 + "..." and samples[1].category == "N/A"
    for frame in eda.values():
        frame.collect()


def test_collection_job(spark, tmp_path):
    page = '<h2><a href="/{0}">{0} plc (ABC.L) dividend notice</a></h2><span class="date">d</span>'
    pages = spark.createDataFrame([(1, page.format("Alpha")), (2, page.format("Beta") * 2)], "page_id long, html string")
    run = jobs.collect_announcements(
        {"investegate": pages, "sharecast": pages}, str(tmp_path), scraped_at=F.lit("2024-01-01T00:00:00")
    )
    assert tuple(run.counts.first()) == (6, 2, 4)
    assert {(r.source, r.n) for r in run.by_source.collect()} == {("Investegate_Direct", 2)}
    assert [r.company_name for r in run.top_companies.collect()] == ["Alpha plc", "Beta plc"]
    assert run.sample.first().preview == "Alpha plc (ABC.L) dividend notice... (ABC)"
    assert spark.read.json(f"{run.path}/records").count() == 2


def test_company_eda(spark):
    df = spark.createDataFrame([("Name", "1/2/2000"), ("Nm", "1/2/2000"), ("N", "x")], "CompanyName string, IncorporationDate string")
    eda = jobs.company_eda(df)
    assert [r.n for r in eda["per_date"].collect()] == [2]
    assert eda["date_range"].first().span_days == 0
    assert eda["name_lengths"].agg(F.sum("n")).first()[0] == 3
    assert set(jobs.company_eda(df.select(F.col("CompanyName").alias("x")))) == {"rows"}
    assert dates.today() is not None


def test_counters_spread_over_rows(spark):
    df = spark.range(1_000).selectExpr("cast(id % 300 as string) as source", "cast(null as string) as kind")
    assert profile.counter(df, "source").count() == 1
    assert profile.counter(df, "source").first().source["7"] == 4
    spread = profile.counter(df, "source", most=50)
    assert spread.count() == 6 and max(len(r.source) for r in spread.collect()) < 100
    values = {r.value: r.n for r in profile.counter_values(spread, "source").collect()}
    assert values == {str(i): 4 if i < 100 else 3 for i in range(300)}
    assert [r.kind for r in profile.counter(df, "kind", "none").collect()] == [{"none": 1_000}]
    assert [r.source for r in profile.counter(df.limit(0), "source").collect()] == [{}]


def test_histogram_shuffles_bins_not_values(spark):
    """A million distinct values: the exchange holds a row per bin and task."""
    df = spark.range(0, 1_000_000, 1, 8).selectExpr("sqrt(id) * 1.7 AS v")
    found = profile.histogram(df, F.col("v"), 20)
    counts, edges = np.histogram(np.sqrt(np.arange(1_000_000)) * 1.7, 20)
    rows = found.orderBy("bin").collect()
    assert [r.n for r in rows] == counts.tolist()
    assert [r.lo for r in rows] == edges[:-1].tolist()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [v" not in plan


def test_examples_of_several_splits(spark, tmp_path):
    for split, n in (("train", 2), ("dev", 1)):
        (tmp_path / f"{split}.sent").write_text("s\n" * n)
        (tmp_path / f"{split}.tup").write_text("a ; b ; r\n" * n)
    (tmp_path / "relations.txt").write_text("r\n")
    found = relations.load_splits(spark, str(tmp_path), ("train", "dev"))
    assert {r.split: r.n for r in relations.examples_per_split(found).collect()} == {"train": 2, "dev": 1}
