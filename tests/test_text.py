import html
import random
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.functions.entities import unescape

PIECES = [
    "&amp;", "&amp", "&am", "&lt;", "&#39;", "&#x27;", "&#128;", "&#0;", "&#xD800;", "&#1114112;",
    "&#99999999999;", "&#x1F600;", "&notit;", "&notin;", "&copy", "&copyx;", "&", "&&", "&#", "&#x",
    "abc", "é", " ", "&NotEqualTilde;", "&#xb;", "&#127;", "&#x1fffe;", "&Aacutefoo", "&yen1", "&zz;",
    "&#13;", "&#129;", ";", "#", "😀", "&😀;",
]


def test_unescape_equals_the_standard_library(column):
    rnd = random.Random(3)
    texts = ["".join(rnd.choices(PIECES, k=rnd.randint(0, 6))) for _ in range(1500)]
    assert column(texts, unescape) == [html.unescape(t) for t in texts]


@pytest.mark.parametrize("base", ["https://h.org/", "https://h.org/p/q/r?z=1"])
def test_join_url_equals_the_standard_library(column, base):
    rnd = random.Random(4)
    parts = ["..", ".", "a", "b;c", "", "x?y", "?q", "#f", "/", "//", "//h.com", "mailto:x", "?", "#", " ", "a:b"]
    links = ["/".join(rnd.choices(parts, k=rnd.randint(1, 4))) for _ in range(800)] + parts + ["http://z/../y"]
    expected = [u if u.startswith("http") else urljoin(base, u) for u in links]
    assert column(links, lambda c: T.join_url(base, c)) == expected


def test_strip_words_and_blank_follow_unicode_white_space(column):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = [p for s in spaces for p in (s, s + "x", "x" + s, s + s + "b" + s + "c", s + "é😀")]
    texts += ["", "x", "​x"]
    assert column(texts, T.strip) == [t.strip() for t in texts]
    assert column(texts, T.words) == [t.split() for t in texts]
    assert column(texts, T.non_blank) == [bool(t.strip()) for t in texts]


def test_clean_text(column):
    cases = {
        None: "",
        "": "",
        "<b>A</b>  &amp;  B": "A & B",
        "&lt;i&gt;x&lt;/i&gt; y": "x y",
        r"a \n b": "a   b",
        "a \u001c b": "a b",
    }
    assert column(list(cases), T.clean_text) == list(cases.values())


def test_company_ticker(column):
    cases = {
        "Tesco plc (TSCO.L) results": ("TSCO", "Tesco plc"),
        "Foo (bar) Baz (QUX:LON)": ("QUX", "Baz"),
        "x (ABC) (DEF) y": ("DEF", "ABC)"),
        "the (ABC) thing": ("ABC", "the"),
        "LLOY: Lloyds Bank, announces": ("LLOY", "Lloyds Bank"),
        "LLOY:   ": ("LLOY", ""),
        "LLOY: ,x": ("LLOY", ""),
        "lower (LSE: VOD) x": ("", ""),
        "": ("", ""),
    }
    found = column(list(cases), T.company_ticker)
    assert [(r.ticker, r.company_name) for r in found] == list(cases.values())


def test_ticker_pattern_is_linear_on_long_titles(column):
    long = "Word " * 40_000
    found = column([long + "(AB.L)", long], T.company_ticker)
    assert [r.ticker for r in found] == ["AB", ""]


def test_classify(column):
    cases = {
        "Final dividend": "results",
        "Dividend declared": "dividend",
        "Refined oil update": "regulatory",
        "Hello": "other",
        None: "other",
    }
    assert column(list(cases), T.classify_announcement) == list(cases.values())
    bounded = column(list(cases), lambda c: T.classify_announcement(c, word_boundary=True))
    assert bounded == ["results", "dividend", "other", "other", "other"]
    with_content = column(["x"], lambda c: T.classify_announcement(c, F.lit("a MERGER")))
    assert with_content == ["acquisition"]


def test_domains(column):
    cases = {"https://a.b:80/c": "a.b:80", "http:x": None, "/news/1": None, "http:///x": "", "x http//y": "y"}
    assert column(list(cases), T.link_domain) == list(cases.values())


def test_previews_and_filters(column):
    assert column(["a" * 41, "b" * 40], lambda c: T.preview(c, 40)) == ["a" * 40 + "...", "b" * 40]
    assert column(["ab"], lambda c: T.preview(c, 80, always=True)) == ["ab..."]
    titles = ["short", "0123456789", "click here", "Read More", "Company announces", "rns"]
    assert column(titles, T.usable_title) == [False, True, False, False, True, False]
    assert column(["click here"], lambda c: T.usable_title(c, drop_generic=False)) == [True]
    assert column(titles, T.announcement_like) == [False, False, False, False, True, False]


def test_prefix_url(column):
    links = ["/a", "b", "http://c"]
    assert column(links, lambda c: T.prefix_url(c, "https://s")) == ["https://s/a", "https://s/b", "http://c"]
    rooted = column(links, lambda c: T.prefix_url(c, "https://s", rooted_only=True))
    assert rooted == ["https://s/a", "b", "http://c"]


def test_jaccard(column):
    other = T.word_set(F.lit("a b c"))
    texts = ["A b", "", "x", "c b a a"]
    assert column(texts, lambda c: T.jaccard(T.word_set(c), other)) == [2 / 3, 0.0, 0.0, 1.0]


def test_one_decimal_equals_the_standard_library(spark):
    values = [0.15, 0.25, 0.35, 0.45, 0.75, 1.05, 2.45, 0.05, 0.03, 0.95, 9.95, 99.95, 1e14 + 0.25, 1e17, -0.05, -2.45, 0.0, -0.0]
    values += [i / 20 for i in range(400)] + [i / 7 for i in range(400)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = df.select("x", T.one_decimal(F.col("x")).alias("s")).collect()
    assert [r.s for r in found] == [f"{r.x:.1f}" for r in found]
