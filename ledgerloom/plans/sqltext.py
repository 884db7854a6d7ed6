"""SQL fragments for the oracle queries. Word lists and patterns are the operators' own, so that
they stand in one place; the logic around them is written again in SQL, and literal cases in the
tests check the lists."""

from __future__ import annotations

from ledgerloom.functions.text import (
    ANNOUNCEMENT_KEYWORDS,
    GENERIC_TITLES,
    LEADING_TICKER,
    NAME_AND_TICKER,
    RNS_INDICATORS,
    TICKER_IN_PARENTHESES,
    WS,
)

STAMP = "'%Y-%m-%d %H:%M:%S.%f'"
EMPTY = "''"


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{WS}+|{WS}+\z', '', 'g')"


def unescape(x: str) -> str:
    """Enough for the references the pages hold; '&amp;' last, so nothing is decoded twice."""
    for name, value in (("quot", '"'), ("copy", "©"), ("middot", "·")):
        x = f"replace({x}, '&{name};', '{value}')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


def clean(x: str) -> str:
    untagged = f"regexp_replace({unescape(f'coalesce({x}, {EMPTY})')}, '<[^>]+>', '', 'g')"
    collapsed = f"trim(regexp_replace({untagged}, '{WS}+', ' ', 'g'), ' ')"
    return rf"replace(replace({collapsed}, '\n', ' '), '\t', ' ')"


def classify(x: str) -> str:
    cases = " ".join(
        f"WHEN regexp_matches(lower({x}), '{'|'.join(words)}') THEN '{name}'"
        for name, words in ANNOUNCEMENT_KEYWORDS.items()
    )
    return f"CASE {cases} ELSE 'other' END"


def ticker(x: str) -> str:
    return f"""CASE WHEN regexp_matches({x}, '{NAME_AND_TICKER}') THEN regexp_extract({x}, '{NAME_AND_TICKER}', 2)
      WHEN regexp_matches({x}, '{LEADING_TICKER}') THEN regexp_extract({x}, '{LEADING_TICKER}', 1)
      ELSE regexp_extract({x}, '{TICKER_IN_PARENTHESES}', 1) END"""


def company(x: str) -> str:
    rest = f"regexp_extract({x}, '{LEADING_TICKER}', 2)"
    inner = f"""CASE WHEN regexp_matches({x}, '{TICKER_IN_PARENTHESES}')
        THEN {strip(f"regexp_extract({x}, '^([^(]+)', 1)")} ELSE '' END"""
    return f"""CASE WHEN regexp_matches({x}, '{NAME_AND_TICKER}') THEN {strip(f"regexp_extract({x}, '{NAME_AND_TICKER}', 1)")}
      WHEN regexp_matches({x}, '{LEADING_TICKER}') THEN
        CASE WHEN regexp_matches({rest}, '^[^:,]') THEN {strip(f"regexp_extract({rest}, '^([^:,]+)', 1)")}
             ELSE {inner} END
      ELSE {inner} END"""


def usable(x: str, generic: bool) -> str:
    test = f"length({x}) >= 10"
    return f"{test} AND lower({x}) NOT IN ({quoted(GENERIC_TITLES)})" if generic else test


def announcement_like(x: str) -> str:
    return f"regexp_matches(lower({x}), '{'|'.join(RNS_INDICATORS)}') AND length({x}) > 15"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{WS}+'), lambda w: w <> '')"


def word_set(x: str) -> str:
    return f"list_distinct({words(f'lower({x})')})"


def domain(x: str) -> str:
    return f"""CASE WHEN contains({x}, 'http') AND contains({x}, '//')
        THEN split_part(split_part({x}, '//', 2), '/', 1) END"""


def non_blank(x: str) -> str:
    return f"({strip(f'coalesce({x}, {EMPTY})')} <> '')"


def pattern_links(regex: str, options: str, title: int, published: int | None, limit: int | None, keep) -> str:
    """A list of link structs of one pattern over ``html``, filtered by ``keep``."""
    q = regex.replace("'", "''")
    group = lambda g: f"regexp_extract_all(html, '{q}', {g}, '{options}')"
    date = f"({group(published)})[i]" if published else "''"
    item = f"{{'link': ({group(1)})[i], 'title': {clean(f'({group(title)})[i]')}, 'published': {date}}}"
    n = f"len({group(1)})" if limit is None else f"least(len({group(1)}), {limit})"
    return f"list_filter(list_transform(range(1, {n} + 1), lambda i: {item}), lambda m: {keep('m.title')})"


def per_page(cascade: list[str], base: str, keys: str = "page_id") -> str:
    """Rows ``keys, pos, link, title, published`` from the first non-empty list of each page."""
    lists = ", ".join(f"{expr} AS l{i}" for i, expr in enumerate(cascade))
    pick = "CASE " + " ".join(f"WHEN len(l{i}) > 0 THEN l{i}" for i in range(len(cascade))) + " END"
    return f"""
      SELECT {keys}, i - 1 AS pos, ls[i].link AS link, ls[i].title AS title,
             ls[i].published AS published
      FROM (SELECT {keys}, ls, unnest(range(1, len(ls) + 1)) AS i
            FROM (SELECT {keys}, {pick} AS ls FROM (SELECT {keys}, {lists} FROM ({base}))))"""
