import random

from ledgerloom.llm.queries_native import RULES
from ledgerloom.llm.url_filter import judge_urls

SCHEMA = "host string, path string, verdict string"


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def urls():
    rng = random.Random(3)
    hosts = ["example.org", "a.example.org", "A.B.Example.ORG", "xexample.org", "org", ".org", "a..org", "com", "x.com:80", "k.net", ""]
    paths = ["", "/", "/en/1", "/en/12", "/en", "/es/x", "/fr/", "/de/é", "/EN/1"]
    tails = ["", "?q=://x/", "#t/", "?a#b"]
    made = [f"{rng.choice(['http', 'HTTP', ''])}://{h}{p}{t}" for h in hosts for p in paths for t in tails]
    return made + [None, "", "no scheme/org/", "://", "http:/org/", "x://" + "a." * 3000 + "org/", "x://org/" + "y" * 20000]


def run(spark, pages, rules):
    return judge_urls(pages, spark.createDataFrame(list(rules), SCHEMA))


def test_against_brute_force(spark):
    rows = list(enumerate(urls())) * 2 + [(None, "x://example.org/es/")]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in rows], "page_id long, url string, host string, rule string")
    for rules in (RULES, (*RULES, ("org", "", "block"), ("Example.org", "/en/1", "allow"), (None, "/", "block"), ("", "/", "block"))):
        found = run(spark, pages, rules).collect()
        same = [(h.lower(), p, v) for h, p, v in rules if h]
        want = [(i, *brute(u, same)) for i, u in rows]
        key = lambda r: tuple(map(str, r))
        assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [tuple(r) for r in run(spark, pages, []).collect()] == [(1, "a.org", "/", None, "allow")]
    assert run(spark, pages.limit(0), RULES).count() == 0
