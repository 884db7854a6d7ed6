from pyspark.sql import functions as F

from ledgerloom.operators import extract, manifest
from ledgerloom.operators.extract import INVESTEGATE, LSE, SHARECAST


def links(spark, html, source=INVESTEGATE, **kw):
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    rows = extract.page_links(pages, source, **kw).orderBy("pos").collect()
    return [(r.link, r.title, r.published) for r in rows]


def test_first_pattern_with_a_survivor_wins(spark):
    html = (
        '<div class="news"><a href="/s">short</a><div class="date">d0</div></div>'
        '<h2><a href="/two">The second pattern</a></h2><span class="date">d1</span>'
        '<a href="/four" title="The fourth pattern">x</a>'
    )
    assert links(spark, html) == [("/two", "The second pattern", "d1")]


def test_limit_cuts_before_filtering(spark):
    html = "".join(f'<h3><a href="/{t}">{t}</a></h3>' for t in ("short", "long enough title", "another long title"))
    assert links(spark, html, SHARECAST, limit=1) == []
    assert links(spark, html, SHARECAST, limit=2) == [("/long enough title", "long enough title", "")]


def test_third_group_is_a_date_only_in_compat_mode(spark):
    html = '<a href="/x" title="A title of some length">anchor text</a>'
    assert links(spark, html) == [("/x", "A title of some length", "")]
    assert links(spark, html, compat=True) == [("/x", "A title of some length", "anchor text")]


def test_generic_titles_are_dropped_for_one_source_only(spark):
    html = '<h2><a href="/x">click here</a></h2><span class="date">d</span>'
    assert links(spark, html) == []
    assert links(spark, html, SHARECAST) == [("/x", "click here", "")]


def test_fallback_looks_at_twice_the_limit_and_keeps_the_limit(spark):
    anchors = "".join(f'<a href="u{i}">Firm {i} announces a thing</a>' for i in range(8))
    html = '<a href="n">nothing of note here</a>' + anchors
    assert [l for l, _, _ in links(spark, html, limit=2)] == ["u0", "u1"]
    quiet = '<a href="n">nothing of note here</a>' * 4 + anchors
    assert links(spark, quiet, limit=2) == []


def test_without_a_limit_every_link_counts(spark):
    many = "".join(f'<h2><a href="/{i}">A long enough title {i}</a></h2><span class="date">d</span>' for i in range(70))
    assert [l for l, _, _ in links(spark, many)] == [f"/{i}" for i in range(70)]
    anchors = "".join(f'<a href="u{i}">Firm {i} announces a thing</a>' for i in range(70))
    quiet = '<a href="n">nothing of note here</a>' * 200 + anchors
    assert [l for l, _, _ in links(spark, quiet)] == [f"u{i}" for i in range(70)]


def test_every_lse_shape(spark):
    json = '{"url":"/n/1","x":2,"title":"A json headline"}'
    assert links(spark, json, LSE) == [("/n/1", "A json headline", "")]
    div = '<div id=news>\n<p><a href="/d">A headline in a div</a>'
    assert links(spark, div, LSE) == [("/d", "A headline in a div", "")]
    assert links(spark, "<p>", LSE) == []


def test_case_and_entities(spark):
    html = '<H2><A HREF="/a">Profit &amp; loss <!-- --></A></H2>'.replace("<!-- -->", "")
    assert links(spark, html, SHARECAST) == [("/a", "Profit & loss", "")]


def test_records_have_all_fields_in_order(spark):
    pages = spark.createDataFrame(
        [(1, '<h2><a href="x.html">Firm plc (FIRM.L) dividend</a></h2><span class="date">d</span>')],
        "page_id long, html string",
    )
    df = extract.announcements_from_pages(pages, INVESTEGATE, scraped_at=F.lit("now"))
    assert df.columns == ["page_id", "pos", *extract.ANNOUNCEMENT_FIELDS]
    row = df.first()
    assert row.link == row.guid == "https://www.investegate.co.uk/x.html"
    assert (row.ticker, row.company_name, row.rns_type) == ("FIRM", "Firm plc", "dividend")
    assert (row.published, row.summary, row.scraped_at, row.source_priority) == ("d", "", "now", 1)


def test_sources_keep_their_order(spark):
    pages = spark.createDataFrame(
        [(2, '<h2><a href="/b">Some later title</a></h2>'), (1, '<h2><a href="/a">Some early title</a></h2>')],
        "page_id long, html string",
    )
    share = extract.announcements_from_pages(pages, SHARECAST)
    entries = spark.createDataFrame(
        [("f", 0, "Feed <b>title</b>", None, "p", "s &amp; final", None, "g")],
        "file string, pos long, title string, link string, published string, summary string, category string, guid string",
    )
    feed = extract.announcements_from_feed(entries)
    both = extract.collect_sources({"sharecast": share, "yahoo": feed}).orderBy("ord").collect()
    assert [r.title for r in both] == ["Feed title", "Some early title", "Some later title"]
    assert (both[0].link, both[0].category, both[0].rns_type, both[0].summary) == ("", "", "results", "s & final")
    only = extract.collect_sources({"sharecast": share, "yahoo": feed}, ["yahoo"])
    assert only.count() == 1


def test_manifest(spark):
    pages = spark.createDataFrame(
        [(1, "BasicCompanyData-2024-01-02-part3_2.zip BasicCompanyData-2020-01-01-part1_9.zip"), (2, "none")],
        "page_id long, html string",
    )
    parts = manifest.snapshot_manifest(pages)
    names = [r.filename for r in parts.orderBy("part").collect()]
    assert names == ["BasicCompanyData-2024-01-02-part1_2.zip", "BasicCompanyData-2024-01-02-part2_2.zip"]
    landed = spark.createDataFrame([(names[0],), (names[0],), ("other.zip",)], "filename string")
    assert [r.filename for r in manifest.missing_parts(parts, landed).collect()] == names[1:]
    assert tuple(manifest.completeness(parts, landed).first()) == (1, 2, False)


PIECES = (
    '<div class="news">', '<DIV id=x class="top news box">', '<div class="date">1 May</div>', '<div class="news date">2 May</div>',
    '<a href="/a">First title</a>', '<a class=c href="b.html" title="A title of its own">Second title</a>', "<a>no link</a>",
    '<h2><a href="/h">A heading</a></h2>', "<h3>", "</h3>", '<span class="date">3 May</span>', "<article>", "</article>", "</div>",
    "text", "\n", '<p title="x=">', '<div news>', "<!-- c -->",
)
BROKEN = ('<div class="news', "<", '">', '<a href="/q', "a < b", '<p x="class=">', '<b y="href="/z">', '<i "odd>')


def test_gaps_left_out_give_the_same_matches(spark):
    """Random pages, whole and broken, against the patterns as they are."""
    import random

    from ledgerloom.functions import text as T

    rnd, pages = random.Random(4), []
    for i in range(1_500):
        pool = PIECES if i % 2 else PIECES + BROKEN
        pages.append((i, "".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 30)))))
    df = spark.createDataFrame(pages, "page_id long, html string").repartition(8)
    for source in (INVESTEGATE, LSE):
        for p in source.patterns:
            if extract.GAP not in p.regex:
                continue
            whole = extract.whole_tags(F.col("html"))
            short = F.when(whole, extract.without_gaps(F.col("html"), p, source.flags)).otherwise(F.col("html"))
            rows = df.select(
                "html",
                whole.alias("whole"),
                T.find_all(short, source.flags + p.regex, p.groups).alias("found"),
                T.find_all(F.col("html"), source.flags + p.regex, p.groups).alias("plain"),
            ).collect()
            assert [r.html for r in rows if r.found != r.plain] == []
            assert sum(r.whole for r in rows) > 700 and any(r.plain for r in rows)


def test_large_pages_take_linear_time(spark):
    """Half a megabyte of openings that no date follows, or no link, or only links."""
    import time

    opening, link, date = '<div class="news">', '<a href="/x">Some long title</a>', '<div class="date">1 May</div>'
    heading = '<h2><a href="/h">A heading of this page</a></h2>'
    n = 12_000
    pages = [opening * 2 * n, (opening + link) * n, link + opening * 2 * n + date, heading * n, (opening + date) * n + link, "<div>" * 4 * n]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").repartition(6).cache()
    extract.page_links(df, INVESTEGATE).count()
    start = time.time()
    for source in (INVESTEGATE, LSE):
        extract.page_links(df, source).count()
    assert time.time() - start < 6
