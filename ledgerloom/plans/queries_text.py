"""Queries over text scalars and link extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import dates, text as T
from ledgerloom.operators import extract, lookup, manifest, profile
from ledgerloom.operators.extract import INVESTEGATE, LSE, SHARECAST
from ledgerloom.plans import jobs, sqltext as S
from ledgerloom.plans.registry import Tables, query
from ledgerloom.session import spread

TITLE = "<title>([^<]*)"
RAW_TITLE_SQL = f"regexp_extract(html, '{TITLE}', 1)"
TITLES_SQL = f"SELECT page_id, {S.clean(RAW_TITLE_SQL)} AS title FROM pages"
STAMP = "2024-06-01T12:00:00.000000"


def raw_title() -> Column:
    return F.regexp_extract("html", TITLE, 1)


def titles(t: Tables) -> DataFrame:
    return t.pages.select("page_id", T.clean_text(raw_title()).alias("title"))


@query("f1_f2_clean_titles", TITLES_SQL)
def _(t):
    return titles(t)


@query("f1_f2_clean_html", f"SELECT page_id, md5({S.clean('html')}) AS digest FROM pages")
def _(t):
    return t.pages.select("page_id", F.md5(T.clean_text(F.col("html"))).alias("digest"))


@query(
    "f4_a8_classify_pages",
    f"SELECT {S.classify('title')} AS rns_type, count(*) AS n FROM ({TITLES_SQL}) GROUP BY 1",
)
def classify_pages(t):
    return profile.frequencies(titles(t), T.classify_announcement(F.col("title")), "rns_type")


@query(
    "f4_classify_documents",
    f"SELECT lang, {S.classify('text')} AS rns_type, count(*) AS n FROM documents GROUP BY 1, 2",
)
def _(t):
    kind = T.classify_announcement(F.col("text"))
    rows = spread(t.documents.select("lang", "text"))
    return rows.groupBy("lang", kind.alias("rns_type")).agg(F.count("*").alias("n"))


@query(
    "f4_classify_two_fields",
    f"""SELECT event_type, {S.classify("event_type || ' ' || props")} AS rns_type, count(*) AS n
        FROM events GROUP BY 1, 2""",
)
def _(t):
    kind = T.classify_announcement(F.col("event_type"), F.col("props"))
    return t.events.groupBy("event_type", kind.alias("rns_type")).agg(F.count("*").alias("n"))


# Titles with every ticker shape, built from the customer's number and segment.
TICK_SQL = "translate(lpad(CAST(c_custkey AS VARCHAR), 3, '0'), '0123456789', 'ABCDEFGHIJ')"
COMPANY_TITLES_SQL = f"""
  SELECT c_custkey, CASE c_custkey % 6
    WHEN 0 THEN c_name || ' plc (' || {TICK_SQL} || '.L) final results'
    WHEN 1 THEN 'the ' || lower(c_name) || ' (' || {TICK_SQL} || ') dividend'
    WHEN 2 THEN {TICK_SQL} || ': ' || c_name || ', announces a contract'
    WHEN 3 THEN lower(c_mktsegment) || ' (lse: ' || {TICK_SQL} || ') update'
    WHEN 4 THEN {TICK_SQL} || ': , ' || c_name || ' (' || {TICK_SQL} || ':LON)'
    ELSE {TICK_SQL} || ':  ' || lower(c_name) || ' (' || {TICK_SQL} || '-X) sale' END AS title
  FROM customer"""


def company_titles(t: Tables) -> DataFrame:
    digits = F.col("c_custkey").cast("string")
    tick = F.translate(
        F.when(F.length(digits) < 3, F.lpad(digits, 3, "0")).otherwise(F.substring(digits, 1, 3)),
        "0123456789", "ABCDEFGHIJ",
    )
    name, shape = F.col("c_name"), F.col("c_custkey") % 6
    title = (
        F.when(shape == 0, F.concat(name, F.lit(" plc ("), tick, F.lit(".L) final results")))
        .when(shape == 1, F.concat(F.lit("the "), F.lower(name), F.lit(" ("), tick, F.lit(") dividend")))
        .when(shape == 2, F.concat(tick, F.lit(": "), name, F.lit(", announces a contract")))
        .when(shape == 3, F.concat(F.lower("c_mktsegment"), F.lit(" (lse: "), tick, F.lit(") update")))
        .when(shape == 4, F.concat(tick, F.lit(": , "), name, F.lit(" ("), tick, F.lit(":LON)")))
        .otherwise(F.concat(tick, F.lit(":  "), F.lower(name), F.lit(" ("), tick, F.lit("-X) sale")))
    )
    return t.customer.select("c_custkey", title.alias("title"), "c_mktsegment")


@query(
    "f3_extract_ticker",
    f"""SELECT c_custkey, title, {S.ticker('title')} AS ticker, {S.company('title')} AS company_name
        FROM ({COMPANY_TITLES_SQL})""",
)
def _(t):
    found = T.company_ticker(F.col("title"))
    rows = company_titles(t).withColumn("found", found)
    return rows.select("c_custkey", "title", "found.ticker", "found.company_name")


@query(
    "f3_ticker_in_documents",
    f"""SELECT doc_id, {S.ticker('text')} AS ticker, md5({S.company('text')}) AS company
        FROM documents""",
)
def _(t):
    rows = t.documents.select("doc_id", T.company_ticker(F.col("text")).alias("f"))
    return rows.select("doc_id", "f.ticker", F.md5("f.company_name").alias("company"))


@query(
    "f5_previews",
    """SELECT doc_id, CASE WHEN length(text) > 40 THEN substr(text, 1, 40) || '...' ELSE text END AS p40,
              CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS p200,
              substr(text, 1, 80) || '...' AS p80 FROM documents""",
)
def _(t):
    text = F.col("text")
    return t.documents.select(
        "doc_id",
        T.preview(text, 40).alias("p40"),
        T.preview(text, 200).alias("p200"),
        T.preview(text, 80, always=True).alias("p80"),
    )


ANY_LINK = INVESTEGATE.any_link.regex
ANCHORS_SQL = f"""
  SELECT page_id, i - 1 AS pos, regexp_extract_all(html, '{ANY_LINK}', 1)[i] AS link,
         {S.clean(f"regexp_extract_all(html, '{ANY_LINK}', 2)[i]")} AS title
  FROM (SELECT page_id, html, unnest(range(1, len(regexp_extract_all(html, '{ANY_LINK}', 1)) + 1)) AS i
        FROM pages)"""


def anchors(t: Tables) -> DataFrame:
    found = T.find_all(F.col("html"), ANY_LINK, ("link", "title"))
    rows = t.pages.select("page_id", F.posexplode(found).alias("pos", "a"))
    return rows.select("page_id", "pos", "a.link", T.clean_text(F.col("a.title")).alias("title"))


@query("f18_page_anchors", ANCHORS_SQL)
def _(t):
    return anchors(t)


@query("w5_first_anchors", f"SELECT * FROM ({ANCHORS_SQL}) WHERE pos < 3")
def _(t):
    found = T.find_all(F.col("html"), ANY_LINK, ("link", "title"), limit=3)
    rows = t.pages.select("page_id", F.posexplode(found).alias("pos", "a"))
    return rows.select("page_id", "pos", "a.link", T.clean_text(F.col("a.title")).alias("title"))


SITE = "https://example.org"


@query(
    "f6_absolute_links",
    f"""SELECT page_id, pos,
          CASE WHEN starts_with(l, '/') THEN '{SITE}' || l WHEN NOT starts_with(l, 'http')
               THEN '{SITE}/' || l ELSE l END AS full_link,
          CASE WHEN starts_with(l, '/') THEN '{SITE}' || l ELSE l END AS rooted_link
        FROM (SELECT page_id, pos, CASE WHEN pos % 2 = 0 THEN link ELSE substr(link, 2) END AS l
              FROM ({ANCHORS_SQL}))""",
)
def _(t):
    link = F.when(F.col("pos") % 2 == 0, F.col("link")).otherwise(F.expr("substr(link, 2)"))
    rows = anchors(t).withColumn("l", link)
    return rows.select(
        "page_id",
        "pos",
        T.prefix_url(F.col("l"), SITE).alias("full_link"),
        T.prefix_url(F.col("l"), SITE, rooted_only=True).alias("rooted_link"),
    )


URL_SHAPES_SQL = """CASE page_id % 6 WHEN 0 THEN '/' || tail WHEN 1 THEN '//' || tail WHEN 2 THEN tail
    WHEN 3 THEN url WHEN 4 THEN '?p=' || page_id ELSE '#s' || page_id END"""


@query(
    "f7_join_urls",
    f"""SELECT page_id, CASE WHEN starts_with(l, 'http') THEN l WHEN starts_with(l, '//') THEN 'https:' || l
          WHEN starts_with(l, '/') THEN 'https://example.org' || l
          ELSE 'https://example.org/' || l END AS link
        FROM (SELECT page_id, {URL_SHAPES_SQL} AS l
              FROM (SELECT page_id, url, split_part(url, '//', 2) AS tail FROM pages))""",
)
def _(t):
    tail = F.split_part("url", F.lit("//"), F.lit(2))
    number = F.col("page_id").cast("string")
    link = (
        F.when(F.col("page_id") % 6 == 0, F.concat(F.lit("/"), tail))
        .when(F.col("page_id") % 6 == 1, F.concat(F.lit("//"), tail))
        .when(F.col("page_id") % 6 == 2, tail)
        .when(F.col("page_id") % 6 == 3, F.col("url"))
        .when(F.col("page_id") % 6 == 4, F.concat(F.lit("?p="), number))
        .otherwise(F.concat(F.lit("#s"), number))
    )
    return t.pages.select("page_id", T.join_url("https://example.org/", link).alias("link"))


@query("f8_link_domains", f"SELECT page_id, {S.domain('url')} AS domain FROM pages")
def _(t):
    return t.pages.select("page_id", T.link_domain(F.col("url")).alias("domain"))


@query(
    "l5_top_domains",
    f"""SELECT {S.domain('url')} AS domain, count(*) AS n FROM pages GROUP BY 1
        ORDER BY n DESC, domain LIMIT 10""",
)
def _(t):
    return profile.top(profile.frequencies(t.pages, T.link_domain(F.col("url")), "domain"), 10)


@query(
    "f14_word_counts",
    f"""SELECT doc_id, len({S.words('text')}) AS n_words, len({S.word_set('text')}) AS n_distinct,
               md5(array_to_string({S.words('text')}, ' ')) AS digest FROM documents""",
)
def _(t):
    text = F.col("text")
    return spread(t.documents.select("doc_id", "text")).select(
        "doc_id",
        F.size(T.words(text)).alias("n_words"),
        F.size(T.word_set(text)).alias("n_distinct"),
        F.md5(F.array_join(T.words(text), " ")).alias("digest"),
    )


@query(
    "f16_u5_jaccard",
    f"""SELECT doc_id, s AS shared, len(a) + len(b) - s AS united,
          round(CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0.0
                ELSE CAST(s AS DOUBLE) / (len(a) + len(b) - s) END, 6) AS similarity
        FROM (SELECT doc_id, a, b, len(list_intersect(a, b)) AS s
              FROM (SELECT d.doc_id, {S.word_set('d.text')} AS a, {S.word_set('k.text')} AS b
                    FROM documents d JOIN benchmark k ON d.doc_id % 40 = k.item_id))""",
)
def _(t):
    docs = spread(t.documents.select((F.col("doc_id") % 40).alias("item_id"), "doc_id", "text"))
    items = t.benchmark.select("item_id", T.word_set(F.col("text")).alias("b"))
    pairs = docs.join(items, "item_id").withColumn("a", T.word_set(F.col("text")))
    a, b = F.col("a"), F.col("b")
    return pairs.select(
        "doc_id",
        F.size(F.array_intersect(a, b)).alias("shared"),
        F.size(F.array_union(a, b)).alias("united"),
        T.jaccard(a, b).alias("similarity"),
    )


@query(
    "f17_f13_strip_lower_length",
    f"""SELECT conv_id, turn, length(text) AS n_chars, length({S.strip("' ' || text || chr(160)")}) AS n_stripped,
               md5(lower(text)) AS digest FROM conversations""",
)
def _(t):
    padded = F.concat(F.lit(" "), F.col("text"), F.lit("\xa0"))
    return t.conversations.select(
        "conv_id",
        "turn",
        F.length("text").alias("n_chars"),
        F.length(T.strip(padded)).alias("n_stripped"),
        F.md5(F.lower("text")).alias("digest"),
    )


@query(
    "p6_p7_title_filters",
    f"""SELECT page_id, title FROM ({TITLES_SQL}) WHERE {S.usable('title', True)}
        UNION ALL SELECT page_id, title FROM (SELECT page_id, title || ' update' AS title FROM ({TITLES_SQL}))
        WHERE {S.announcement_like('title')}""",
)
def _(t):
    title = F.col("title")
    marked = titles(t).withColumn("title", F.concat(title, F.lit(" update")))
    return titles(t).where(T.usable_title(title)).union(marked.where(T.announcement_like(title)))


# Pages in the layouts of a news site: the page's own title and number in one of five shapes.
NEWS_SQL = f"""SELECT page_id, CASE page_id % 5
  WHEN 0 THEN '<div class="big news-item"><a class="x" href="/a/' || page_id || '">' || t ||
       '</a> by <div class="date">2024-01-02</div></div>'
  WHEN 1 THEN '<h2 id="h"><a href="item/' || page_id || '.html">' || t || '</a></h2> <span class="date">Tue</span>'
  WHEN 2 THEN '<a class="l" HREF="/news/' || page_id || '">' || t || ' rns notice</a>'
  WHEN 3 THEN '<a href="/x/' || page_id || '" title="' || t || '">more</a><a href="/y" title="short">more</a>'
  ELSE '<a href="/z/' || page_id || '">' || t || ' announces results</a>' END || html AS html
  FROM (SELECT page_id, html, {RAW_TITLE_SQL} AS t FROM pages)"""


def news_pages(t: Tables) -> DataFrame:
    n, s, h = F.col("page_id").cast("string"), F.col("page_id") % 5, raw_title()
    c = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    shape = (
        F.when(s == 0, c('<div class="big news-item"><a class="x" href="/a/', n, '">', h,
                         '</a> by <div class="date">2024-01-02</div></div>'))
        .when(s == 1, c('<h2 id="h"><a href="item/', n, '.html">', h,
                        '</a></h2> <span class="date">Tue</span>'))
        .when(s == 2, c('<a class="l" HREF="/news/', n, '">', h, " rns notice</a>"))
        .when(s == 3, c('<a href="/x/', n, '" title="', h,
                        '">more</a><a href="/y" title="short">more</a>'))
        .otherwise(c('<a href="/z/', n, '">', h, " announces results</a>"))
    )
    return t.pages.select("page_id", F.concat(shape, "html").alias("html"))


def cascade_sql(source: extract.PageSource, base: str, limit: int | None) -> str:
    options = "is" if "s" in source.flags else "i"
    lists = [
        S.pattern_links(
            p.regex, options, p.groups.index("title") + 1,
            p.groups.index("published") + 1 if "published" in p.groups else None,
            limit, lambda x: S.usable(x, source.drop_generic),
        )
        for p in source.patterns
    ]
    if source.any_link:
        scan, cut = (None, "") if limit is None else (2 * limit, f"[1:{limit}]")
        lists.append(
            f"""({S.pattern_links(source.any_link.regex, 'c', 2, None, scan,
                                  S.announcement_like)}){cut}"""
        )
    return S.per_page(lists, base)


def record_sql(source: extract.PageSource, base: str, link: str, limit: int | None) -> str:
    return f"""SELECT page_id, pos, title, {link} AS link,
        CASE WHEN published <> '' THEN published ELSE '{STAMP}' END AS published, '' AS summary,
        '{source.category}' AS category, '{source.author}' AS author, {link} AS guid,
        '{source.name}' AS source, '{source.url}' AS source_url, CAST({source.priority} AS BIGINT) AS source_priority,
        {S.ticker('title')} AS ticker, {S.company('title')} AS company_name,
        {S.classify('title')} AS rns_type, '{STAMP}' AS scraped_at
      FROM ({cascade_sql(source, base, limit)})"""


PREFIX_SQL = f"""CASE WHEN starts_with(link, '/') THEN '{INVESTEGATE.site}' || link
    WHEN NOT starts_with(link, 'http') THEN '{INVESTEGATE.site}/' || link ELSE link END"""


def join_sql(site: str) -> str:
    return f"""CASE WHEN starts_with(link, 'http') THEN link WHEN starts_with(link, '//') THEN 'https:' || link
      WHEN starts_with(link, '/') THEN '{site[:-1]}' || link ELSE '{site}' || link END"""


@query("s10_page_links_cascade", cascade_sql(INVESTEGATE, NEWS_SQL, 50))
def _(t):
    return extract.page_links(news_pages(t), INVESTEGATE, 50)


@query("s10_p11_announcements", record_sql(INVESTEGATE, NEWS_SQL, PREFIX_SQL, 50))
def _(t):
    return extract.announcements_from_pages(news_pages(t), INVESTEGATE, 50, scraped_at=F.lit(STAMP))


LSE_SQL = f"""SELECT page_id, CASE page_id % 3
  WHEN 0 THEN html || '<article><h3 class="a">x <a class="b" href="rel/n' || page_id || '?x=1#f">' || t || '</a></h3>'
  WHEN 1 THEN replace(html, '<article', '<section') || '<div id="news"><a href="//other.example.org/' || page_id || '">' || t || '</a>'
  ELSE replace(html, '<article', '<section') || '{{"url":"/n/' || page_id || '","id":5,"title":"' || t || '"}}' END AS html
  FROM (SELECT page_id, html, {RAW_TITLE_SQL} AS t FROM pages)"""


def lse_pages(t: Tables) -> DataFrame:
    n, s, h = F.col("page_id").cast("string"), F.col("page_id") % 3, raw_title()
    c = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    html = F.col("html")
    bare = F.replace(html, F.lit("<article"), F.lit("<section"))
    shape = (
        F.when(s == 0, c(html, '<article><h3 class="a">x <a class="b" href="rel/n', n, '?x=1#f">', h, "</a></h3>"))
        .when(s == 1, c(bare, '<div id="news"><a href="//other.example.org/', n, '">', h, "</a>"))
        .otherwise(c(bare, '{"url":"/n/', n, '","id":5,"title":"', h, '"}'))
    )
    return t.pages.select("page_id", shape.alias("html"))


@query("s11_announcements", record_sql(LSE, LSE_SQL, join_sql(LSE.site), 30))
def _(t):
    return extract.announcements_from_pages(lse_pages(t), LSE, 30, scraped_at=F.lit(STAMP))


SHARECAST_SQL = f"""SELECT page_id, CASE page_id % 3
  WHEN 0 THEN '<h3><a href="/m/' || page_id || '">' || t || '</a></h3><h2><a href="/short">short</a></h2>'
  WHEN 1 THEN '<A href="m/' || page_id || '" class="top headline">' || t || '</A>' ELSE '' END || html AS html
  FROM (SELECT page_id, html, {RAW_TITLE_SQL} AS t FROM pages)"""


def sharecast_pages(t: Tables) -> DataFrame:
    n, s, h = F.col("page_id").cast("string"), F.col("page_id") % 3, raw_title()
    c = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    shape = (
        F.when(s == 0, c('<h3><a href="/m/', n, '">', h, '</a></h3><h2><a href="/short">short</a></h2>'))
        .when(s == 1, c('<A href="m/', n, '" class="top headline">', h, "</A>"))
        .otherwise("")
    )
    return t.pages.select("page_id", F.concat(shape, "html").alias("html"))


@query("s12_announcements", record_sql(SHARECAST, SHARECAST_SQL, join_sql(SHARECAST.site), 20))
def _(t):
    return extract.announcements_from_pages(sharecast_pages(t), SHARECAST, 20, scraped_at=F.lit(STAMP))


@query(
    "q1_announcement_types",
    f"""SELECT source, rns_type, count(*) AS n, count(*) FILTER (published <> '{STAMP}') AS dated
        FROM ({record_sql(INVESTEGATE, NEWS_SQL, PREFIX_SQL, None)}) GROUP BY 1, 2""",
)
def announcement_types(t):
    found = extract.announcements_from_pages(news_pages(t), INVESTEGATE, scraped_at=F.lit(STAMP))
    return found.groupBy("source", "rns_type").agg(
        F.count("*").alias("n"), F.count_if(F.col("published") != STAMP).alias("dated")
    )


# Over all links of a page; the rows above test the argument.
@query("s10_p11_announcements_whole", record_sql(INVESTEGATE, NEWS_SQL, PREFIX_SQL, None))
def _(t):
    return extract.announcements_from_pages(news_pages(t), INVESTEGATE, scraped_at=F.lit(STAMP))


@query("s11_announcements_whole", record_sql(LSE, LSE_SQL, join_sql(LSE.site), None))
def _(t):
    return extract.announcements_from_pages(lse_pages(t), LSE, scraped_at=F.lit(STAMP))


@query("s12_announcements_whole", record_sql(SHARECAST, SHARECAST_SQL, join_sql(SHARECAST.site), None))
def _(t):
    return extract.announcements_from_pages(sharecast_pages(t), SHARECAST, scraped_at=F.lit(STAMP))


UNION_SQL = " UNION ALL ".join(
    f"SELECT source, title, link FROM ({q})"
    for q in (
        record_sql(INVESTEGATE, NEWS_SQL, PREFIX_SQL, 50),
        record_sql(LSE, LSE_SQL, join_sql(LSE.site), 50),
        record_sql(SHARECAST, SHARECAST_SQL, join_sql(SHARECAST.site), 50),
    )
)


WHOLE_UNION_SQL = " UNION ALL ".join(
    f"SELECT source, title, link FROM ({q})"
    for q in (
        record_sql(INVESTEGATE, NEWS_SQL, PREFIX_SQL, None),
        record_sql(LSE, LSE_SQL, join_sql(LSE.site), None),
        record_sql(SHARECAST, SHARECAST_SQL, join_sql(SHARECAST.site), None),
    )
)


def all_branches(t: Tables, limit: int | None = 50) -> dict[str, DataFrame]:
    stamp = F.lit(STAMP)
    return {
        "investegate": extract.announcements_from_pages(news_pages(t), INVESTEGATE, limit, scraped_at=stamp),
        "lse": extract.announcements_from_pages(lse_pages(t), LSE, limit, scraped_at=stamp),
        "sharecast": extract.announcements_from_pages(sharecast_pages(t), SHARECAST, limit, scraped_at=stamp),
    }


@query("u1_union_sources", UNION_SQL)
def _(t):
    return extract.collect_sources(all_branches(t)).select("source", "title", "link")


@query("u1_union_sources_whole", WHOLE_UNION_SQL)
def _(t):
    return extract.collect_sources(all_branches(t, None)).select("source", "title", "link")


@query("p10_selected_sources", f"SELECT * FROM ({WHOLE_UNION_SQL}) WHERE source <> '{LSE.name}'")
def _(t):
    chosen = extract.collect_sources(all_branches(t, None), ("investegate", "sharecast"))
    return chosen.select("source", "title", "link")


SOURCE_VALUES = ", ".join(f"('{n}', '{k}', '{u}', {p})" for n, k, u, p in extract.SOURCE_REGISTRY)


@query(
    "p11_source_constants",
    f"""SELECT e.event_id, e.source, r.type, r.source_url, CAST(r.source_priority AS BIGINT) AS source_priority
        FROM (SELECT event_id, CASE event_type WHEN 'click' THEN 'Investegate_Direct'
                WHEN 'view' THEN 'Yahoo_Finance_UK' WHEN 'error' THEN 'Proactive_UK'
                ELSE event_type END AS source FROM events) e
        LEFT JOIN (VALUES {SOURCE_VALUES}) r(source, type, source_url, source_priority)
          ON e.source = r.source""",
)
def _(t):
    kind = F.col("event_type")
    source = (
        F.when(kind == "click", "Investegate_Direct")
        .when(kind == "view", "Yahoo_Finance_UK")
        .when(kind == "error", "Proactive_UK")
        .otherwise(kind)
    )
    rows = extract.with_source_constants(t.events.select("event_id", source.alias("source")))
    return rows.select("event_id", "source", "type", "source_url", "source_priority")


# A register page per web page: the text, then the names of a snapshot of 1 to 7 parts.
REGISTER_SQL = """SELECT page_id, html || '<a>BasicCompanyData-2024-01-0' || (1 + page_id % 9) || '-part1_'
    || (1 + page_id % 7) || '.zip</a> BasicCompanyData-2023-01-01-part9_9.zip' AS html FROM pages"""
MANIFEST_SQL = """SELECT page_id, snapshot_date, total_parts, part, 'BasicCompanyData-' || snapshot_date
    || '-part' || part || '_' || total_parts || '.zip' AS filename
  FROM (SELECT page_id, '2024-01-0' || (1 + page_id % 9) AS snapshot_date, 1 + page_id % 7 AS total_parts,
               unnest(range(1, 2 + page_id % 7)) AS part FROM pages)"""


def register_pages(t: Tables) -> DataFrame:
    day, total = 1 + F.col("page_id") % 9, 1 + F.col("page_id") % 7
    html = F.concat(
        "html", F.lit("<a>BasicCompanyData-2024-01-0"), day.cast("string"), F.lit("-part1_"),
        total.cast("string"), F.lit(".zip</a> BasicCompanyData-2023-01-01-part9_9.zip"),
    )
    return t.pages.select("page_id", html.alias("html"))


@query("s16_snapshot_manifest", MANIFEST_SQL)
def _(t):
    return manifest.snapshot_manifest(register_pages(t))


def landed_parts(t: Tables) -> DataFrame:
    parts = manifest.snapshot_manifest(register_pages(t))
    return parts.where((F.col("part") + F.substring("snapshot_date", -1, 1).cast("int")) % 3 != 0)


LANDED_SQL = f"""SELECT filename FROM ({MANIFEST_SQL})
    WHERE (part + CAST(right(snapshot_date, 1) AS INT)) % 3 <> 0"""


@query(
    "j6_missing_parts",
    f"SELECT page_id, filename FROM ({MANIFEST_SQL}) WHERE filename NOT IN ({LANDED_SQL})",
)
def _(t):
    parts = manifest.snapshot_manifest(register_pages(t))
    return manifest.missing_parts(parts, landed_parts(t)).select("page_id", "filename")


@query(
    "j6_snapshot_completeness",
    f"""SELECT count(*) FILTER (filename IN ({LANDED_SQL})) AS landed, count(*) AS total,
          count(*) FILTER (filename IN ({LANDED_SQL})) = count(*) AS complete FROM ({MANIFEST_SQL})""",
)
def _(t):
    return manifest.completeness(manifest.snapshot_manifest(register_pages(t)), landed_parts(t))


@query(
    "q9_snapshot_report",
    f"""SELECT 'announced' AS stat, filename AS value FROM ({MANIFEST_SQL})
        UNION ALL SELECT 'missing', filename FROM ({MANIFEST_SQL}) WHERE filename NOT IN ({LANDED_SQL})
        UNION ALL SELECT 'totals', count(*) FILTER (filename IN ({LANDED_SQL})) || ' of ' || count(*) FROM ({MANIFEST_SQL})""",
)
def _(t):
    """All outputs of the job in long form."""
    report = jobs.snapshot_report(register_pages(t), landed_parts(t))
    totals = F.concat(F.col("landed").cast("string"), F.lit(" of "), F.col("total").cast("string"))
    announced = report["manifest"].select(F.lit("announced").alias("stat"), F.col("filename").alias("value"))
    missing = report["missing"].select(F.lit("missing"), "filename")
    return announced.union(missing).union(report["totals"].select(F.lit("totals"), totals))


USE_CASES = " ".join(
    f"WHEN contains(name, '{k}') THEN '{v}'" for k, v in reversed(list(lookup.IDEAL_USES.items()))
)


@query(
    "j4_ideal_use",
    f"""SELECT doc_id, name, CASE {USE_CASES} END AS ideal_use
        FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'boe_cls_' || source WHEN 1 THEN 'ch_' || lang
              WHEN 2 THEN lang || '_boe' WHEN 3 THEN 'rns_transcripts' || source ELSE source END AS name
              FROM documents)""",
)
def _(t):
    s = F.col("doc_id") % 5
    name = (
        F.when(s == 0, F.concat(F.lit("boe_cls_"), "source"))
        .when(s == 1, F.concat(F.lit("ch_"), "lang"))
        .when(s == 2, F.concat("lang", F.lit("_boe")))
        .when(s == 3, F.concat(F.lit("rns_transcripts"), "source"))
        .otherwise(F.col("source"))
    )
    rows = t.documents.select("doc_id", name.alias("name"))
    return rows.withColumn("ideal_use", lookup.ideal_use(F.col("name")))


# One instant per event, printed in eight ways and as junk.
DATE_TEXT_SQL = """CASE event_id % 10
    WHEN 0 THEN strftime(ts, '%a, %d %b %Y %H:%M:%S GMT') WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+01:00')
    WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
    WHEN 4 THEN strftime(ts, '%Y-%m-%d') WHEN 5 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
    WHEN 6 THEN strftime(ts, '%a, %d %b %Y %H:%M:%S +0000') WHEN 7 THEN '2024-02-30' WHEN 8 THEN event_type
    ELSE NULL END"""


def date_texts(t: Tables) -> DataFrame:
    s, ts = F.col("event_id") % 10, F.col("ts")
    show = lambda pattern: F.date_format(ts, pattern)
    text = (
        F.when(s == 0, show("EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
        .when(s == 1, show("yyyy-MM-dd'T'HH:mm:ss'+01:00'"))
        .when(s == 2, show("yyyy-MM-dd'T'HH:mm:ss"))
        .when(s == 3, show("yyyy-MM-dd HH:mm:ss"))
        .when(s == 4, show("yyyy-MM-dd"))
        .when(s == 5, show("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(s == 6, show("EEE, dd MMM yyyy HH:mm:ss '+0000'"))
        .when(s == 7, "2024-02-30")
        .when(s == 8, F.col("event_type"))
    )
    return t.events.select("event_id", text.alias("published"))


def parse_sql(extended: bool) -> str:
    """``event_id, ts, fmt`` by the first format that parses."""
    shapes = [
        ("%a, %d %b %Y %H:%M:%S %Z", "try_strptime(published, '%a, %d %b %Y %H:%M:%S GMT')"),
        ("%Y-%m-%dT%H:%M:%S%z",
         "try_strptime(replace(published, '+01:00', ''), '%Y-%m-%dT%H:%M:%S') - INTERVAL 1 HOUR"),
        ("%Y-%m-%dT%H:%M:%S", "try_strptime(published, '%Y-%m-%dT%H:%M:%S')"),
        ("%Y-%m-%d %H:%M:%S", "try_strptime(published, '%Y-%m-%d %H:%M:%S')"),
        ("%Y-%m-%d", "try_strptime(published, '%Y-%m-%d')"),
    ]
    if extended:
        shapes += [
            ("%Y-%m-%dT%H:%M:%S.%f", "try_strptime(published, '%Y-%m-%dT%H:%M:%S.%f')"),
            ("%a, %d %b %Y %H:%M:%S %z", "try_strptime(published, '%a, %d %b %Y %H:%M:%S +0000')"),
        ]
    guard = lambda fmt: "AND contains(published, '+01:00')" if fmt.endswith("S%z") else ""
    stamp = " ".join(f"WHEN {x} IS NOT NULL {guard(f)} THEN {x}" for f, x in shapes)
    tag = " ".join(f"WHEN {x} IS NOT NULL {guard(f)} THEN '{f}'" for f, x in shapes)
    return f"""SELECT event_id, CASE {stamp} END AS ts, CASE {tag} END AS fmt
               FROM (SELECT event_id, {DATE_TEXT_SQL} AS published FROM events)"""


def parsed_dates(t: Tables, formats) -> DataFrame:
    rows = date_texts(t).select("event_id", dates.parse_published(F.col("published"), formats).alias("p"))
    return rows.select("event_id", "p.ts", "p.fmt")


for _name, _formats, _extended in (
    ("f9_parse_mixed_dates", dates.DEFAULT_FORMATS, True),
    ("f9_parse_compat_dates", dates.COMPAT_FORMATS, False),
):
    query(_name, f"SELECT event_id, strftime(ts, {S.STAMP}) AS ts, fmt FROM ({parse_sql(_extended)})")(
        lambda t, formats=_formats: parsed_dates(t, formats)
    )


@query(
    "a20_format_counts",
    f"SELECT fmt, count(*) AS n FROM ({parse_sql(True)}) WHERE fmt IS NOT NULL GROUP BY 1",
)
def _(t):
    parsed = parsed_dates(t, dates.DEFAULT_FORMATS).where("fmt is not null")
    return profile.frequencies(parsed, F.col("fmt"), "fmt")


@query(
    "a4_parse_rate",
    f"""SELECT count(ts) AS parsed, count(*) AS total, round(count(ts) / count(*), 6) AS rate
        FROM ({parse_sql(True)})""",
)
def _(t):
    return profile.parse_rate(parsed_dates(t, dates.DEFAULT_FORMATS), F.col("ts"))
