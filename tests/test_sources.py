import json
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import profile
from ledgerloom.plans import jobs
from ledgerloom.sinks import writers
from ledgerloom.sources import listing, records, tables, zips


def put_zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members:
            z.writestr(name, text)


def test_csv_types_missing_values_and_quotes(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        'day,open,n,flag,text,odd\n2020-01-01,1.5,1,True,"a ""q"",\nb",NA\n2020-01-02,NA,2,False,NULL,x1\n'
    )
    df = tables.read_csv(spark, str(tmp_path / "p.csv"))
    assert dict(df.dtypes) == {
        "day": "string", "open": "double", "n": "bigint", "flag": "boolean", "text": "string", "odd": "string"
    }
    rows = [tuple(r) for r in df.orderBy("n").collect()]
    assert rows == [("2020-01-01", 1.5, 1, True, 'a "q",\nb', None), ("2020-01-02", None, 2, False, None, "x1")]


def test_csv_with_schema_needs_no_inference(spark, tmp_path):
    (tmp_path / "p.csv").write_text("a,b\n1,x\n")
    df = tables.read_csv(spark, str(tmp_path / "p.csv"), schema="a int, b string")
    assert [tuple(r) for r in df.collect()] == [(1, "x")]


def test_csv_tree_unites_by_name(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text("a,b\n1,2\n")
    (tmp_path / "y.csv").write_text("b,a\n3,4\n5,6\n")
    (tmp_path / "z.csv").write_text("a,c\n7,t\n")
    (tmp_path / "n.txt").write_text("a,b\n9,9\n")
    df = tables.read_csv_tree(spark, str(tmp_path))
    got = sorted((r.a, r.b, r.c) for r in df.collect())
    assert got == [(1, 2, None), (4, 3, None), (6, 5, None), (7, None, "t")]


def test_phrasebank_names(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.read_phrasebank(spark, str(tmp_path), "no_such")
    with pytest.raises(FileNotFoundError):
        tables.read_phrasebank(spark, str(tmp_path), "sentences_75agree")
    rows = spark.createDataFrame([("s, one", 2), ('"two"', 0)], "sentence string, label int")
    back = jobs.label_sentences(rows, ["negative", "neutral", "positive"], str(tmp_path), "sentences_75agree")
    assert sorted(tuple(r) for r in back.collect()) == [('"two"', 0, "negative"), ("s, one", 2, "positive")]


def test_zip_parts(spark, tmp_path):
    put_zip(tmp_path / "b.zip", [("x.txt", "no"), ("b.csv", 'a,b\n1,"x\ny"\nNA,\n'), ("c.csv", "a\n9\n")])
    put_zip(tmp_path / "a.zip", [("a.csv", "b,c\n01,2\n")])
    put_zip(tmp_path / "c.zip", [("readme", "none")])
    df = tables.read_zip_csv(spark, str(tmp_path), part_column="part", chunk_rows=1)
    assert df.columns == ["part", "b", "c", "a"]
    got = sorted((tuple(r) for r in df.collect()), key=str)
    assert got == [("a.zip", "01", "2", None), ("b.zip", "x\ny", None, "1"), ("b.zip", None, None, None)]
    only = tables.read_zip_csv(spark, str(tmp_path), ["a"])
    assert sorted(str(r.a) for r in only.collect()) == ["1", "None", "None"]


def test_zip_larger_than_a_batch_of_lines(spark, tmp_path):
    """Many splits and Arrow batches per archive, stored and deflated members, and a comment at the end."""
    body = "".join(f"{i},é{i * 7919 % 10007},{'y' * (i % 50)}\n" for i in range(60_000))
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("noise.bin", bytes(range(256)) * 4_000)
        z.writestr("big.csv", "a,b,c\n" + body)
        z.comment = b"ends with a break\n"
    with zipfile.ZipFile(tmp_path / "plain.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("plain.csv", "b,d\n" + "k,v\n" * 30_000)
    with zipfile.ZipFile(tmp_path / "bz.zip", "w", zipfile.ZIP_BZIP2) as z:
        z.writestr("m.csv", "a\n5\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 50_000)
    try:
        df = tables.read_zip_csv(spark, str(tmp_path), part_column="part")
        assert df.columns == ["part", "a", "b", "c", "d"]
        counts = {r.part: r["count"] for r in df.groupBy("part").count().collect()}
        assert counts == {"big.zip": 60_000, "plain.zip": 30_000, "bz.zip": 1}
        big = df.where("part = 'big.zip'").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r.a, r.b) for r in big] == [(str(i), f"é{i * 7919 % 10007}") for i in range(60_000)]
    found = zips.members(spark, str(tmp_path)).orderBy("part", "place").collect()
    assert [(r.part, r.member) for r in found] == [
        ("big.zip", "noise.bin"), ("big.zip", "big.csv"), ("bz.zip", "m.csv"), ("plain.zip", "plain.csv")
    ]
    assert [r.size for r in found][1] == len(("a,b,c\n" + body).encode())


def test_no_zips_give_an_empty_table(spark, tmp_path):
    assert tables.read_zip_csv(spark, str(tmp_path)).count() == 0
    assert records.read_announcements(spark, str(tmp_path)).count() == 0
    put_zip(tmp_path / "c.zip", [("readme", "none")])
    assert tables.read_zip_csv(spark, str(tmp_path)).count() == 0


def test_company_parts_become_ordered_shards(spark, tmp_path):
    for part in range(3):
        body = "".join(f"n{part}{i},{1 + i}/1/2000\n" for i in range(4))
        extra = "old,1/1/1800\nbad,31/02/2001\n,1/1/2000\n" + "x" * 81 + ",1/1/2000\n"
        put_zip(tmp_path / f"p{part}.zip", [("d.csv", "CompanyName,IncorporationDate\n" + extra + body)])
    out = jobs.clean_company_parts(spark, str(tmp_path), str(tmp_path / "out"), shard_size=5, null_name=None)
    df = spark.read.parquet(out)
    assert df.columns == ["CompanyName", "IncorporationDate", "date", "source", "part"]
    shards = {}
    for r in df.collect():
        shards.setdefault(r.part, set()).add(r.CompanyName)
    names = [f"n{p}{i}" for p in range(3) for i in range(4)]
    assert shards == {f"part_{k:05d}": set(names[5 * k : 5 * k + 5]) for k in range(3)}
    missing = jobs.clean_company_parts(spark, str(tmp_path), str(tmp_path / "o2"))
    assert spark.read.parquet(missing).where("CompanyName = 'nan'").count() == 3


def test_tolerant_jsonl(spark, tmp_path):
    good = {"title": "t", "source": "s", "source_priority": 1, "extra": [1]}
    odd = {"title": "u", "source_priority": "x", "published": None}
    (tmp_path / "b.jsonl").write_text(
        "\n".join(['{"_metadata": {"total_records": 2}}', json.dumps(good), "", "{broken", "  "]) + "\n"
    )
    (tmp_path / "a.jsonl").write_text(json.dumps(odd) + "\n" + json.dumps(good) + " tail\n[1]\n7\n")
    (tmp_path / "other.json").write_text(json.dumps(good))
    rows = records.read_announcements(spark, str(tmp_path), keep_file=True).orderBy("file").collect()
    assert [(r.file, r.title, r.source, r.source_priority) for r in rows] == [
        ("a.jsonl", "u", None, None), ("b.jsonl", "t", "s", 1)
    ]
    placed = records.read_announcements(spark, str(tmp_path), keep_order=True).orderBy("ord")
    assert [r.title for r in placed.collect()] == ["u", "t"]
    kept = records.read_announcements(spark, str(tmp_path), drop_metadata_rows=False)
    assert kept.count() == 3
    report = {r.file: (r.records, r.bad_lines) for r in records.jsonl_line_report(spark, str(tmp_path)).collect()}
    assert report == {"a.jsonl": (1, 3), "b.jsonl": (2, 1)}
    bad = sorted((r.file, r.line_no) for r in records.rejected_lines(spark, str(tmp_path)).collect())
    assert bad == [("a.jsonl", 2), ("a.jsonl", 3), ("a.jsonl", 4), ("b.jsonl", 4)]
    assert records.jsonl_line_count(spark, str(tmp_path)).first().num_rows == 9


def test_rejected_entries_and_unread_files(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>a & b</title></item><item><title>c</title></item></channel></rss>")
    assert [r.title for r in records.read_feed(spark, str(tmp_path)).collect()] == ["c"]
    bad = records.rejected_entries(spark, str(tmp_path)).collect()
    assert [(r.file, r.value) for r in bad] == [("f.xml", "<item><title>a & b</title></item>")]
    (tmp_path / "good.jsonl").write_text("{}\n")
    (tmp_path / "none.jsonl").write_text("")
    (tmp_path / "bad.jsonl.gz").write_bytes(b"no gzip at all")
    found = records.unread_files(spark, str(tmp_path), "*.jsonl*").collect()
    assert [r.file for r in found] == ["bad.jsonl.gz"]


def test_headers_with_quoted_newlines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"n\n1",x\n1,2\n')
    (tmp_path / "b.csv").write_text('"n\n2",x\n3,4\n')
    (tmp_path / "c.csv").write_text('"n\nz",y\n5,6\n')
    df = tables.read_csv_tree(spark, str(tmp_path))
    assert sorted(df.columns) == sorted(["n\n1", "x", "n\n2", "n\nz", "y"])
    got = sorted((tuple(r[c] for c in ("n\n1", "n\n2", "n\nz", "x", "y")) for r in df.collect()), key=str)
    assert got == sorted([(1, None, None, 2, None), (None, 3, None, 4, None), (None, None, 5, None, 6)], key=str)


def test_missing_values_with_a_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text("s,i\nNA,1\nx,NA\n")
    df = tables.read_csv(spark, str(tmp_path / "a.csv"), "s string, i int")
    assert sorted(map(tuple, df.collect()), key=str) == sorted([(None, 1), ("x", None)], key=str)


def test_source_order_with_several_files_per_task(spark, tmp_path):
    from ledgerloom.operators.index import source_order_index

    spark.conf.set("spark.sql.files.maxRecordsPerFile", 3)
    try:
        df = spark.range(0, 20, 1, 2).select((F.col("id") / 10).cast("int").alias("s"), "id")
        found = source_order_index(df, "s").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert sorted((r.idx, r.id) for r in found) == [(i, i) for i in range(20)]


def test_feed(spark, tmp_path):
    items = "".join(
        f"<item><title>T{i} &amp;amp; x</title><link>l{i}</link><pubDate>p</pubDate>"
        f"<description>&lt;b&gt;d&lt;/b&gt;</description><category>c1</category><category>c2</category>"
        f"<guid{' isPermaLink=\"false\"' if i % 2 else ''}>g{i}</guid></item>"
        for i in range(5)
    )
    (tmp_path / "f.xml").write_text(f"<rss><channel><title>feed</title>{items}</channel></rss>")
    rows = records.read_feed(spark, str(tmp_path), limit=3).orderBy("pos").collect()
    assert [(r.pos, r.title, r.link, r.summary, r.category, r.guid) for r in rows] == [
        (i, f"T{i} &amp; x", f"l{i}", "<b>d</b>", "c1", f"g{i}") for i in range(3)
    ]


def test_feed_over_many_splits(spark, tmp_path):
    """Entries cut by split borders, entries without an end, and names that only begin like one."""
    item = lambda i: f"<item><title>T{i} é</title><description>{'x' * (i % 400)}</description></item>"
    parts = [item(i) + ("\n" if i % 3 else "") for i in range(3_000)]
    parts[7] = "<item><title>no end</title>"
    (tmp_path / "a.xml").write_text("<rss><channel>" + "".join(parts) + "</channel></rss>")
    odd = "<rss><items>x</items>" + item(1) + "<item ><title>a</title><itemized/>" + item(2) + "<item\n><title>b</title></item ></rss>"
    (tmp_path / "b.xml").write_text(odd)
    (tmp_path / "c.xml").write_text("<rss>nothing</rss>")
    (tmp_path / "d.xml").write_text(item(5) + item(6))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 10_000)
    try:
        found = records._feed_items(spark, str(tmp_path))
        assert found.select(F.spark_partition_id()).distinct().count() > 20
        rows = [(r.file, r.pos, r.value) for r in found.select("file", "pos", "value").collect()]
        good = records.read_feed(spark, str(tmp_path)).where("file = 'a.xml'").count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    want = [("a.xml", i, "".join(p)[: len(p.rstrip())]) for i, p in enumerate(parts)]
    assert sorted(r for r in rows if r[0] == "a.xml") == want and good == 2_999
    assert sorted(r[1:] for r in rows if r[0] == "b.xml") == [
        (0, item(1)), (1, "<item ><title>a</title><itemized/>"), (2, item(2)), (3, "<item\n><title>b</title></item >")
    ]
    assert sorted(r[1:] for r in rows if r[0] == "d.xml") == [(0, item(5)), (1, item(6))]
    assert not [r for r in rows if r[0] == "c.xml"]


def test_announcement_sink_keeps_metadata_apart(spark, tmp_path):
    rows = [("é title", "S", "results", "Firm", "FI"), ("two", "S", "other", "", "")]
    df = spark.createDataFrame(rows, "title string, source string, rns_type string, company_name string, ticker string")
    out = writers.write_announcements(df, str(tmp_path))
    back = records.read_announcements(spark, f"{out}/records")
    assert sorted(r.title for r in back.collect()) == ["two", "é title"]
    meta = json.loads(spark.read.text(f"{out}/metadata").first().value)
    assert meta["total_records"] == 2 and meta["sources"] == {"S": 2}
    assert meta["rns_types"] == {"results": 1, "other": 1}
    assert (meta["companies_identified"], meta["unique_tickers"]) == (1, 1)


def test_metadata_of_many_sources(spark, tmp_path):
    df = spark.range(50_000).selectExpr(
        "cast(id as string) AS title", "concat('s', id) AS source", "'other' AS rns_type", "'' AS company_name", "'' AS ticker"
    )
    out = writers.write_announcements(df, str(tmp_path))
    meta = records.read_metadata(spark, f"{out}/metadata")
    assert meta.count() == 5 and [r.total_records for r in meta.where("total_records IS NOT NULL").collect()] == [50_000]
    sources = profile.counter_values(meta, "sources")
    assert sources.count() == 50_000 == sources.where("n = 1").select("value").distinct().count()
    assert [tuple(r) for r in profile.counter_values(meta, "rns_types").collect()] == [("other", 50_000)]


def test_splits_prune_partitions(spark, tmp_path):
    part = lambda n: spark.range(n).withColumn("x", F.lit("v"))
    configs = {"a": {"train": part(3), "val": part(1)}, "b": {"train": part(2)}}
    counts = jobs.policy_splits(configs, str(tmp_path / "s"))
    assert {r.split: r.n for r in counts.collect()} == {"train": 5, "val": 1}
    val = tables.read_split(spark, str(tmp_path / "s"), "validation")
    assert val.count() == 1 and len(val.inputFiles()) >= 1
    plan = val._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert tables.read_split(spark, str(tmp_path / "s")).count() == 6
    with pytest.raises(ValueError, match="trian"):
        tables.read_split(spark, str(tmp_path / "s"), "trian")


def test_listing_sizes_equal_the_disk(spark, tmp_path):
    base = tmp_path / "raw"
    for name, data in {
        "a/x.csv": "h\n1\n", "a/y.jsonl": "{}\n", "b/d/z.jsonl": "{}\n{}\n", "c/e/f/w.bin": "12345", "c/v.bin": "1",
        "b/dataset_card.json": "{}",
    }.items():
        path = base / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(data)
    sizes = {r.dataset: (r.size_bytes, r.format, r.files) for r in
             listing.dataset_sizes(listing.dataset_files(spark, str(base))).collect()}
    few = listing.dataset_files(spark, str(base), batch=2)
    assert len(few.inputFiles()) > 3
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, listing.dataset_files(spark, str(base)).collect()))
    # c holds two files and two folders
    assert sizes == {"a": (7, "csv", None), "b": (6, "jsonl", None), "c": (6, "other", 4)}
    for name, data in {"a/raw/x.csv": "123", "a/_x": "12", "a/.x": "1", "b/my_dataset_card.json": "12345"}.items():
        (base / name).parent.mkdir(parents=True, exist_ok=True)
        (base / name).write_text(data)
    (base / "e" / "f").mkdir(parents=True)
    (base / "empty").mkdir()
    more = {r.dataset: (r.size_bytes, r.format, r.files) for r in
            listing.dataset_sizes(listing.dataset_files(spark, str(base))).collect()}
    assert more["a"] == (13, "csv", None) and more["b"] == (11, "jsonl", None)
    assert more["e"] == (0, "other", 1) and more["empty"] == (0, "other", 0)
    for name in ("a/raw/x.csv", "a/_x", "a/.x", "b/my_dataset_card.json"):
        (base / name).unlink()
    (base / "e" / "f").rmdir()
    (base / "e").rmdir()
    (base / "empty").rmdir()
    cards = jobs.profile_datasets(spark, str(base))
    lines = [r.line for r in writers.overview_markdown(cards).collect()]
    assert lines[4:] == ["| `a` | 1 | 0.0 | - |", "| `b` | 2 | 0.0 | - |", "| `c` | - | 0.0 | - |"]


def test_cards_of_many_datasets_take_a_fixed_number_of_jobs(spark, tmp_path):
    """Types and labels are judged per dataset, also where datasets share column names."""
    def build(base, copies):
        for i in range(copies):
            for name, text in {
                f"d{i} x+é/a.csv": "id,kind,text\n1,a,long 1\n2,b,long 2\n3,a,\n",
                f"d{i} x+é/sub/b.csv": "kind,,kind2\nNA,5,true\nc,6,false\n",
                f"n{i}/a.csv": "id,kind\n" + "".join(f"{j},{j}\n" for j in range(5)),
                f"h{i}/only.csv": "x,y\n",
                f"j{i}/l.jsonl": "{}\n\n{}\n",
                f"o{i}/z.bin": "..",
            }.items():
                (base / name).parent.mkdir(parents=True, exist_ok=True)
                (base / name).write_text(text)

    jobs_run = []
    for copies in (1, 4):
        base = tmp_path / str(copies)
        build(base, copies)
        spark.sparkContext.setJobGroup(f"cards{copies}", "")
        cards = {r.name: r for r in jobs.profile_datasets(spark, str(base)).collect()}
        jobs_run.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"cards{copies}")))
        assert len(cards) == 5 * copies
        d = cards[f"d{copies - 1} x+é"]
        assert (d.num_rows, d.columns, d.files) == (5, ["id", "kind", "text", "_c1", "kind2"], None)
        assert d.path.endswith(f"/d{copies - 1} x+é")
        assert d.label_distributions == {"kind": {"a": 2, "b": 1, "c": 1}, "text": {"long 1": 1, "long 2": 1}}
        n, h, j, o = (cards[f"{c}{copies - 1}"] for c in "nhjo")
        assert (n.num_rows, n.label_distributions) == (5, None)
        assert (h.num_rows, h.columns) == (0, ["x", "y"])
        assert (j.num_rows, j.columns, j.format) == (3, None, "jsonl") and (o.num_rows, o.files) == (None, 1)
    spark.sparkContext.setJobGroup("", "")
    assert jobs_run[1] <= jobs_run[0] + 2 and jobs_run[0] > 0
