"""Announcement records from tables of landed pages and feed entries.

A page is handled inside its own row: each pattern gives an array of links, unusable titles are
filtered within the array, the first pattern with a survivor wins, and only then are rows made.
There is no shuffle, and later patterns are not tried once one has won.

A pattern with gaps (``first .*? second .*? third``) would scan the rest of the page from every
``first`` that finds no ``third``. So a page is cut, in one pass, into the pieces that its segments
match; pieces that no match can begin or end with are left out, and the pattern then runs over what
is left, where every ``first`` succeeds. Gaps hold nothing that is kept, so the links are the same. This
needs tags that are whole; a page with an open tag or quote is read as it is.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.functions import dates, text as T

ANNOUNCEMENT_SCHEMA = (
    "title string, link string, published string, summary string, category string, "
    "author string, guid string, source string, source_url string, source_priority int, "
    "ticker string, company_name string, rns_type string, scraped_at string"
)
ANNOUNCEMENT_FIELDS = [f.split()[0] for f in ANNOUNCEMENT_SCHEMA.split(", ")]


@dataclass(frozen=True)
class LinkPattern:
    """A pattern and what its groups hold; every pattern names at least ``link`` and ``title``."""

    regex: str
    groups: tuple[str, ...] = ("link", "title")

    @property
    def segments(self) -> list[str]:
        """The parts between gaps, without groups."""
        return [re.sub(r"\((?!\?)", "(?:", part) for part in self.regex.split(".*?")]


@dataclass(frozen=True)
class PageSource:
    """One site: its constants, its patterns in order of preference, how its links resolve."""

    key: str
    name: str
    url: str
    site: str
    author: str
    category: str
    priority: int
    patterns: tuple[LinkPattern, ...]
    flags: str = "(?ius)"
    drop_generic: bool = False
    join: bool = True
    any_link: LinkPattern | None = None


# Link shapes per site, and each site's constants.
INVESTEGATE = PageSource(
    key="investegate",
    name="Investegate_Direct",
    url="https://www.investegate.co.uk/",
    site="https://www.investegate.co.uk",
    author="Investegate",
    category="rns",
    priority=1,
    patterns=(
        LinkPattern(
            r'<div[^>]*class="[^"]*news[^"]*"[^>]*>.*?<a[^>]*href="([^"]+)"[^>]*>([^<]+)</a>'
            r'.*?<div[^>]*class="[^"]*date[^"]*"[^>]*>([^<]+)</div>',
            ("link", "title", "published"),
        ),
        LinkPattern(
            r'<h[23][^>]*><a[^>]*href="([^"]+)"[^>]*>([^<]+)</a></h[23]>'
            r'.*?<span[^>]*class="[^"]*date[^"]*"[^>]*>([^<]+)</span>',
            ("link", "title", "published"),
        ),
        LinkPattern(r'href="(/news/[^"]+)"[^>]*>([^<]+RNS[^<]*)</a>'),
        LinkPattern(
            r'<a[^>]*href="(/[^"]+)"[^>]*title="([^"]*)"[^>]*>([^<]+)</a>',
            ("link", "title", "text"),
        ),
    ),
    drop_generic=True,
    join=False,
    any_link=LinkPattern(r'<a[^>]*href="([^"]+)"[^>]*>([^<]+)</a>'),
)
LSE = PageSource(
    key="lse",
    name="LSE_News_Direct",
    url="https://www.londonstockexchange.com/news",
    site="https://www.londonstockexchange.com/",
    author="LSE",
    category="regulatory",
    priority=2,
    patterns=(
        LinkPattern(
            r'<article[^>]*>.*?<h[23][^>]*>.*?<a[^>]*href="([^"]+)"[^>]*>([^<]+)</a>'
        ),
        LinkPattern(r'<div[^>]*news[^>]*>.*?<a[^>]*href="([^"]+)"[^>]*>([^<]+)</a>'),
        LinkPattern(r'"url":"([^"]+)"[^}]*"title":"([^"]+)"'),
    ),
)
SHARECAST = PageSource(
    key="sharecast",
    name="ShareCast_UK",
    url="https://www.sharecast.com/market-news",
    site="https://www.sharecast.com/",
    author="ShareCast",
    category="market_news",
    priority=2,
    patterns=(
        LinkPattern(r'<h[23][^>]*><a[^>]*href="([^"]+)"[^>]*>([^<]+)</a></h[23]>'),
        LinkPattern(
            r'<a[^>]*href="([^"]+)"[^>]*class="[^"]*headline[^"]*"[^>]*>([^<]+)</a>'
        ),
    ),
    flags="(?iu)",
)
PAGE_SOURCES = {s.key: s for s in (INVESTEGATE, LSE, SHARECAST)}
# The order in which sources are collected; it decides which of two near-duplicates stays.
SOURCE_ORDER = ("investegate", "lse", "yahoo", "sharecast")

YAHOO_NAME = "Yahoo_Finance_UK"
YAHOO_AUTHOR = "Yahoo Finance"
YAHOO_URL = "https://feeds.finance.yahoo.com/rss/2.0/headline?s=^FTSE&region=GB&lang=en-GB"
YAHOO_PRIORITY = 3

# The registry of known sources (name, type, url, priority).
SOURCE_REGISTRY = (
    ("Investegate_Direct", "scrape", "https://www.investegate.co.uk/", 1),
    ("Investegate_Search", "scrape", "https://www.investegate.co.uk/search.aspx?q=&sort=date", 1),
    ("LSE_News_Direct", "scrape", "https://www.londonstockexchange.com/news", 2),
    ("ShareCast_UK", "scrape", "https://www.sharecast.com/market-news", 2),
    ("Morningstar_UK", "scrape", "https://www.morningstar.co.uk/uk/news/", 3),
    ("Yahoo_Finance_UK", "rss", YAHOO_URL, 3),
    ("Proactive_UK", "scrape", "https://www.proactiveinvestors.co.uk/news/", 3),
)


def source_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(SOURCE_REGISTRY), "source string, type string, source_url string, source_priority int"
    )


def with_source_constants(df: DataFrame) -> DataFrame:
    """Add the registry's columns by ``source``; the registry is seven fixed rows."""
    return df.join(F.broadcast(source_dimension(df.sparkSession)), "source", "left")


GAP = ".*?"
# A tag: no angle brackets inside, quotes in pairs, and no value that ends like an attribute begins.
WHOLE_TAG = r'(?i)<(?:[^<>"]|"[^<>"]*(?<!class=)(?<!href=)(?<!title=)")*+>'


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def whole_tags(html: Column) -> Column:
    """Whether every ``<`` of a page begins a whole tag."""
    return F.regexp_count(html, F.lit("<")) == F.regexp_count(html, F.lit(WHOLE_TAG))


def _last(flags: Column) -> Column:
    """The 1-based place of the last true value, 0 without one."""
    back = F.array_position(F.reverse(flags), True).cast("int")
    return F.when(back > 0, F.size(flags) + 1 - back).otherwise(0)


def without_gaps(html: Column, pattern: LinkPattern, flags: str) -> Column:
    """A text of the same matches as ``html``, whose tags are whole: the pieces its segments match, up to
    the end of the last possible match; of several openings in a row only the first."""
    parts = pattern.segments
    one = flags + "(" + "|".join(reversed(parts)) + ")"
    is_part = [lambda t, p=p: t.rlike(f"{flags}^(?:{p})") for p in parts]

    def kept(pieces: Column) -> Column:
        # Per piece which segments it matches; a closing piece may be an opening too.
        marks = F.transform(
            pieces, lambda t: F.struct(t.alias("t"), *[f(t).alias(f"s{i}") for i, f in enumerate(is_part)])
        )
        return bound(marks, joined)

    def joined(marks: Column) -> Column:
        flag = lambda i: F.transform(marks, lambda m: m[f"s{i}"])
        end = _last(flag(len(parts) - 1))
        if len(parts) == 3:
            # The last middle piece with a closing one behind it, and the first of these.
            middle = bound(end, lambda e: _last(F.slice(flag(1), 1, F.greatest(e - 1, F.lit(0)))))
            return bound(middle, lambda j: F.when(j > 0, three(marks, flag(2), j)).otherwise(""))
        return F.array_join(F.transform(openings(F.slice(marks, 1, end)), lambda m: m["t"]), " ")

    def three(marks: Column, closing: Column, middle: Column) -> Column:
        rest = F.slice(closing, middle + 1, F.size(closing))
        end = F.element_at(marks, middle + F.array_position(rest, True).cast("int"))
        body = F.array_join(F.transform(openings(F.slice(marks, 1, middle)), lambda m: m["t"]), " ")
        return F.concat_ws(" ", body, end["t"])

    def openings(marks: Column) -> Column:
        only = lambda m: m["s0"] & ~reduce(lambda a, b: a | b, (m[f"s{i}"] for i in range(1, len(parts))))
        return bound(
            marks,
            lambda ms: F.filter(
                ms, lambda m, i: ~((i > 0) & only(m) & F.coalesce(only(F.get(ms, i - 1)), F.lit(False)))
            ),
        )

    return bound(F.regexp_extract_all(html, F.lit(one), F.lit(1)), kept)


def links_by_pattern(
    html: Column,
    pattern: LinkPattern,
    flags: str,
    limit: int | None,
    keep,
    scan: int | None = None,
    whole: Column | None = None,
) -> Column:
    """One pattern's links with cleaned titles, as an array with a fixed element type.

    ``whole`` tells whether the page's tags are (default: it is looked at).

    ``scan`` matches are looked at (default: ``limit``), those with ``keep(title)`` stay, at most
    ``limit`` of them.
    """
    if GAP in pattern.regex:
        whole = whole_tags(html) if whole is None else whole
        html = F.when(whole, without_gaps(html, pattern, flags)).otherwise(html)
    found = T.find_all(html, flags + pattern.regex, pattern.groups, scan or limit)
    dated = "published" in pattern.groups
    shaped = F.transform(
        found,
        lambda m: F.struct(
            m["link"].alias("link"),
            T.clean_text(m["title"]).alias("title"),
            (m["published"] if dated else F.lit("")).alias("published"),
        ),
    )
    kept = F.filter(shaped, lambda m: keep(m["title"]))
    return F.slice(kept, 1, limit) if scan and limit else kept


def first_non_empty(arrays: Sequence[Column]) -> Column:
    """The first array with an element; later ones are evaluated only when needed."""
    return F.coalesce(
        *[F.get(F.filter(F.array(a), lambda links: F.size(links) > 0), F.lit(0)) for a in arrays]
    )


def page_links(
    pages: DataFrame,
    source: PageSource,
    limit: int | None = None,
    html: str = "html",
    compat: bool = False,
) -> DataFrame:
    """One row per surviving link: the page's other columns, ``pos``, ``link``, ``title``,
    ``published``. ``limit`` looks only at a page's first matches; without it at all.

    ``compat`` reads a pattern's third group as the date even where it is the anchor text.
    """
    patterns = source.patterns
    if compat:
        patterns = [
            LinkPattern(p.regex, ("link", "title", "published")) if len(p.groups) == 3 else p
            for p in patterns
        ]
    page, whole = F.col(html), F.col("_whole")
    cascade = [
        links_by_pattern(
            page, p, source.flags, limit, lambda t: T.usable_title(t, source.drop_generic), whole=whole
        )
        for p in patterns
    ]
    if source.any_link:
        cascade.append(
            links_by_pattern(
                page, source.any_link, "", limit, T.announcement_like, 2 * limit if limit else None
            )
        )
    others = [c for c in pages.columns if c != html]
    if any(GAP in p.regex for p in patterns):
        pages = pages.withColumn("_whole", whole_tags(page))
    hits = pages.select(*others, F.posexplode(first_non_empty(cascade)).alias("pos", "hit"))
    return hits.select(*others, "pos", "hit.link", "hit.title", "hit.published")


def announcements_from_pages(
    pages: DataFrame,
    source: PageSource,
    limit: int | None = None,
    html: str = "html",
    scraped_at: Column | None = None,
    compat: bool = False,
) -> DataFrame:
    """Full announcement records, preceded by the page's other columns and ``pos``.

    ``scraped_at`` also stands in for a date the page does not give.
    """
    stamp = scraped_at if scraped_at is not None else dates.iso_now()
    links = page_links(pages, source, limit, html, compat)
    keys = [c for c in pages.columns if c != html] + ["pos"]
    if source.join:
        link = T.join_url(source.site, F.col("link"))
    else:
        link = T.prefix_url(F.col("link"), source.site)
    resolved = links.select(*keys, "title", link.alias("link"), "published")
    return _complete(
        resolved,
        keys,
        published=F.when(F.col("published") != "", F.col("published")).otherwise(stamp),
        summary=F.lit(""),
        category=F.lit(source.category),
        author=F.lit(source.author),
        guid=F.col("link"),
        source=F.lit(source.name),
        source_url=F.lit(source.url),
        source_priority=F.lit(source.priority),
        content=None,
        scraped_at=stamp,
    )


def announcements_from_feed(entries: DataFrame, scraped_at: Column | None = None) -> DataFrame:
    """Announcement records of feed entries (columns as :func:`read_feed` gives them)."""
    stamp = scraped_at if scraped_at is not None else dates.iso_now()
    keys = [c for c in entries.columns if c not in FEED_FIELDS]
    blank = F.lit("")
    cleaned = entries.select(
        *keys,
        T.clean_text(F.col("title")).alias("title"),
        T.clean_text(F.col("summary")).alias("summary"),
        *[F.coalesce(F.col(c), blank).alias(c) for c in ("link", "published", "category", "guid")],
    )
    return _complete(
        cleaned,
        keys,
        published=F.col("published"),
        summary=F.col("summary"),
        category=F.col("category"),
        author=F.lit(YAHOO_AUTHOR),
        guid=F.col("guid"),
        source=F.lit(YAHOO_NAME),
        source_url=F.lit(YAHOO_URL),
        source_priority=F.lit(YAHOO_PRIORITY),
        content=F.col("summary"),
        scraped_at=stamp,
    )


FEED_FIELDS = ("title", "link", "published", "summary", "category", "guid")


def _complete(df: DataFrame, keys, content: Column | None, **columns: Column) -> DataFrame:
    title = F.col("title")
    columns |= {
        "title": title,
        "link": F.col("link"),
        "rns_type": T.classify_announcement(title, content),
        "ticker": F.col("_company.ticker"),
        "company_name": F.col("_company.company_name"),
    }
    return df.withColumn("_company", T.company_ticker(title)).select(
        *keys, *[columns[f].alias(f) for f in ANNOUNCEMENT_FIELDS]
    )


def collect_sources(
    branches: Mapping[str, DataFrame],
    selected: Sequence[str] = ("all",),
    page_key: str = "page_id",
    feed_key: str = "file",
) -> DataFrame:
    """Union the chosen branches; ``ord`` is the record order: source, then page, then position.

    A branch has the announcement columns, ``pos``, and its page number or feed file.
    """
    wanted = SOURCE_ORDER if "all" in selected else [s for s in SOURCE_ORDER if s in selected]
    parts = []
    for rank, key in enumerate(wanted):
        if key not in branches:
            continue
        df = branches[key]
        page = F.col(page_key) if page_key in df.columns else F.lit(0)
        feed = F.col(feed_key) if feed_key in df.columns else F.lit("")
        order = F.struct(
            F.lit(rank).alias("source_rank"),
            page.cast("long").alias("page"),
            feed.alias("feed"),
            F.col("pos").cast("long").alias("pos"),
        )
        parts.append(df.select(order.alias("ord"), *ANNOUNCEMENT_FIELDS))
    if not parts:
        raise ValueError(f"none of {list(selected)} among {sorted(branches)}")
    return reduce(DataFrame.unionByName, parts)
