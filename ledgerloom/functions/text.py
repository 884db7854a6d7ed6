"""Text scalars: every function takes and returns Columns and stays in the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import urlsplit

from pyspark.sql import Column, functions as F

from ledgerloom.functions.entities import bind, unescape

# One whitespace class for every engine: it is what str.split/str.strip treat as white space.
WS = r"[\t\n\x0b\f\r\x1c-\x1f\x85\p{Z}]"

_WS_CHARACTERS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Announcement types, in order of precedence, with their keywords.
ANNOUNCEMENT_KEYWORDS: Mapping[str, Sequence[str]] = {
    "results": (
        "results", "earnings", "interim", "final", "half year", "full year", "quarterly",
        "q1", "q2", "q3", "q4",
    ),
    "trading_update": ("trading update", "trading statement", "guidance", "outlook", "forecast"),
    "acquisition": ("acquisition", "merger", "takeover", "purchase", "buy", "acquire"),
    "disposal": ("disposal", "sale", "sell", "divestment", "divest"),
    "dividend": ("dividend", "distribution", "payment", "payout", "yield"),
    "appointment": (
        "appointment", "director", "ceo", "cfo", "chairman", "board", "joins", "named",
    ),
    "fundraising": (
        "fundraising", "placing", "rights issue", "share issue", "capital", "funding",
    ),
    "contract": ("contract", "award", "wins", "secured", "agreement", "deal"),
    "regulatory": ("regulatory", "compliance", "investigation", "fine", "penalty"),
}

# Words that mark a link text as announcement-like, and texts too generic to keep.
RNS_INDICATORS = ("rns", "announces", "results", "update", "dividend", "acquisition", "appoint")
GENERIC_TITLES = ("more", "read more", "click here")

# Ticker shapes "Name (TICK.L)", "(TICK)", "TICK: Name, ...".
NAME_AND_TICKER = rf"([A-Z][^(]*?){WS}*\(([A-Z]{{2,5}})(?:[:.](?:LON|L))?\)"
TICKER_IN_PARENTHESES = r"\(([A-Z]{2,5})\)"
LEADING_TICKER = rf"^([A-Z]{{2,5}}):{WS}*([^\n]+)"

# The first shape again, for a backtracking matcher: each stretch between two '(' is scanned once,
# so a long text costs linear time. The name keeps trailing white space and is stripped later.
_NAME_AND_TICKER_LINEAR = (
    r"(?:^|\()[^A-Z(]*+([A-Z][^(]*+)\(([A-Z]{2,5})(?:[:.](?:LON|L))?\)"
)


def strip(text: Column) -> Column:
    """Trim Unicode white space at both ends."""
    return F.btrim(text, F.lit(_WS_CHARACTERS))


def clean_text(text: Column) -> Column:
    """Decode references, drop tags, collapse white space; null becomes ''.

    Literal two-character ``\\n`` and ``\\t`` sequences are replaced last, and the result is not
    collapsed again.
    """
    untagged = F.regexp_replace(unescape(F.coalesce(text, F.lit(""))), "<[^>]+>", "")
    collapsed = F.trim(F.regexp_replace(untagged, f"{WS}+", " "))
    return F.replace(F.replace(collapsed, F.lit("\\n"), F.lit(" ")), F.lit("\\t"), F.lit(" "))


def company_ticker(title: Column) -> Column:
    """``struct<ticker, company_name>`` read from an announcement title; '' where not found."""
    full_ticker = F.regexp_extract(title, _NAME_AND_TICKER_LINEAR, 2)
    full_name = strip(F.regexp_extract(title, _NAME_AND_TICKER_LINEAR, 1))
    inner_ticker = F.regexp_extract(title, TICKER_IN_PARENTHESES, 1)
    inner_name = F.when(
        inner_ticker != "", strip(F.regexp_extract(title, r"^([^(]+)", 1))
    ).otherwise("")
    lead_ticker = F.regexp_extract(title, LEADING_TICKER, 1)
    lead_rest = F.regexp_extract(title, LEADING_TICKER, 2)

    def pair(ticker: Column, name: Column) -> Column:
        return F.struct(ticker.alias("ticker"), name.alias("company_name"))

    return (
        F.when(full_ticker != "", pair(full_ticker, full_name))
        .when(
            lead_ticker != "",
            pair(
                lead_ticker,
                F.when(
                    lead_rest.rlike("^[^:,]"), strip(F.regexp_extract(lead_rest, "^([^:,]+)", 1))
                ).otherwise(inner_name),
            ),
        )
        .otherwise(pair(inner_ticker, inner_name))
    )


def contains_any(text: Column, words: Sequence[str], word_boundary: bool = False) -> Column:
    """True where ``text`` holds any of ``words``, as substrings or as whole words."""
    if word_boundary:
        return text.rlike(rf"\b(?:{'|'.join(words)})\b")
    found = F.contains(text, F.lit(words[0]))
    for word in words[1:]:
        found = found | F.contains(text, F.lit(word))
    return found


def classify_announcement(
    title: Column, content: Column | None = None, word_boundary: bool = False
) -> Column:
    """The first announcement type with a keyword in the text, else ``other``."""
    parts = [F.coalesce(title, F.lit(""))]
    if content is not None:
        parts.append(F.coalesce(content, F.lit("")))

    # lower() is written once per branch but evaluated once: code generation shares it. Plain
    # substring search beats one alternation pattern per type about threefold.
    text = F.lower(F.concat_ws(" ", *parts))
    branches = None
    for name, words in ANNOUNCEMENT_KEYWORDS.items():
        hit = contains_any(text, words, word_boundary)
        branches = F.when(hit, name) if branches is None else branches.when(hit, name)
    return branches.otherwise("other")


def announcement_like(title: Column) -> Column:
    """Longer than 15 characters and holding an announcement indicator."""
    return contains_any(F.lower(title), RNS_INDICATORS) & (F.length(title) > 15)


def usable_title(title: Column, drop_generic: bool = True) -> Column:
    """At least 10 characters and, if asked, none of the generic link texts."""
    long_enough = F.length(title) >= 10
    return long_enough & ~F.lower(title).isin(*GENERIC_TITLES) if drop_generic else long_enough


def preview(text: Column, size: int, always: bool = False) -> Column:
    """The first ``size`` characters and '...'; a short text stays as it is unless ``always``."""
    cut = F.concat(F.substring(text, 1, size), F.lit("..."))
    return cut if always else F.when(F.length(text) > size, cut).otherwise(text)


def prefix_url(link: Column, site: str, rooted_only: bool = False) -> Column:
    """Put ``site`` before a relative link; ``rooted_only`` leaves links without a leading '/'."""
    rooted = F.when(link.startswith("/"), F.concat(F.lit(site), link))
    if not rooted_only:
        rooted = rooted.when(~link.startswith("http"), F.concat(F.lit(site + "/"), link))
    return rooted.otherwise(link)


def join_url(base: str, link: Column) -> Column:
    """RFC 3986 resolution of ``link`` against the fixed ``base``; absolute links stay."""
    parts = urlsplit(base)
    root = f"{parts.scheme}://{parts.netloc}"
    folder = [s for s in parts.path.split("/")[:-1] if s]
    tidy = F.regexp_replace(F.regexp_replace(link, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")

    def resolve(url: Column) -> Column:
        shape = r"^(?s)(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?"
        host = F.regexp_extract(url, shape, 1)
        path = F.regexp_extract(url, shape, 2)
        query = F.regexp_extract(url, shape, 3)
        fragment = F.regexp_extract(url, shape, 4)
        tail = F.concat(
            F.when(query == "?", "").otherwise(query),
            F.when(fragment == "#", "").otherwise(fragment),
        )
        steps = F.split(path, "/")
        # Repeated slashes survive in a rooted path; in a relative one empty inner steps go.
        inherited = F.array(*[F.lit(s) for s in ["", *folder]])
        segments = F.when(path.startswith("/"), steps).otherwise(
            F.concat(
                inherited,
                F.filter(F.slice(steps, F.lit(1), F.size(steps) - 1), lambda s: s != ""),
                F.slice(steps, -1, 1),
            )
        )

        def step(done: Column, s: Column) -> Column:
            up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
            return F.when(s == "..", up).when(s == ".", done).otherwise(F.concat(done, F.array(s)))

        def walked(segs: Column) -> Column:
            stack = F.aggregate(segs, F.array().cast("array<string>"), step)
            ends_in_dots = F.element_at(segs, -1).isin(".", "..")
            closed = F.when(ends_in_dots, F.concat(stack, F.array(F.lit("")))).otherwise(stack)
            return F.regexp_replace(F.array_join(closed, "/"), r"^(?!/)", "/")

        rebuilt = F.concat(F.lit(root), bind(segments, walked), tail)
        own_query = F.when(query.isin("", "?"), F.lit("?" + parts.query if parts.query else ""))
        in_place = F.concat(
            F.lit(root + parts.path),
            own_query.otherwise(query),
            F.when(fragment == "#", "").otherwise(fragment),
        )
        return (
            F.when(url == "", base)
            .when(url.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), link)
            .when(F.length(host) > 2, F.concat(F.lit(parts.scheme + ":"), host, path, tail))
            .when(path == "", in_place)
            .otherwise(rebuilt)
        )

    return F.when(link.startswith("http"), link).otherwise(bind(tidy, resolve))


def link_domain(link: Column) -> Column:
    """Text between the first '//' and the next '/', port included; null where there is none."""
    usable = F.contains(link, F.lit("http")) & F.contains(link, F.lit("//"))
    after = F.split_part(link, F.lit("//"), F.lit(2))
    return F.when(usable, F.split_part(after, F.lit("/"), F.lit(1)))


def words(text: Column) -> Column:
    """White-space tokens, none of them empty; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{WS}+"), "")


def word_set(text: Column) -> Column:
    return F.array_distinct(words(F.lower(text)))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two word sets; 0 where either is empty."""
    shared = F.size(F.array_intersect(a, b))
    ratio = shared.cast("double") / (F.size(a) + F.size(b) - shared)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(ratio)


def find_all(text: Column, pattern: str, groups: Sequence[str], limit: int | None = None) -> Column:
    """All matches as ``array<struct<groups...>>``, in order, at most ``limit`` of them.

    The text is scanned once; the groups are then read from the few matched pieces. The pattern
    must not look beyond its own match (no look-around, no anchors).
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if limit is not None:
        matches = F.slice(matches, 1, limit)
    return F.transform(
        matches,
        lambda m: F.struct(
            *[F.regexp_extract(m, pattern, i + 1).alias(g) for i, g in enumerate(groups)]
        ),
    )


def non_empty(value: Column) -> Column:
    """Neither null nor ''."""
    return F.coalesce(value, F.lit("")) != ""


def non_blank(value: Column) -> Column:
    """Neither null nor white space only."""
    return F.coalesce(value.rlike(f"(?!{WS})(?s:.)"), F.lit(False))


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def one_decimal(x: Column) -> Column:
    """One decimal place of the double itself, not of its printed form: 0.15 is a little less than
    0.15, so it gives 0.1. An exact half goes to the even digit."""
    x = x.cast("double")
    size = F.abs(x)
    whole = F.floor(size)
    # Doubles from 1/32 on are multiples of 2^-57, so the scaled fraction is an exact integer.
    ten = ((size - whole) * F.lit(2.0**57)).cast("long") * 10
    digit, rest = F.shiftright(ten, 57), ten.bitwiseAND(F.lit(2**57 - 1))
    half = F.lit(2**56)
    up = (rest > half) | ((rest == half) & (digit % 2 == 1))
    tenths = whole.cast("long") * 10 + digit + up.cast("long")
    sign = F.when(x.cast("string").startswith("-"), "-").otherwise("")  # a negative zero too
    exact = F.concat(sign, (F.floor(tenths / 10)).cast("string"), F.lit("."), (tenths % 10).cast("string"))
    return F.when(size < 1e15, exact).otherwise(F.format_string("%.1f", x))


def percent(share: Column) -> Column:
    return F.concat(one_decimal(share * 100), F.lit("%"))
