"""Secret scan: fixed patterns, and a battery of randomness tests. DataFrame functions only.

*Base.* ``assign``, ``access`` and ``hex`` are leftmost non-overlapping matches of their patterns;
matches that are too short are dropped, not searched again.

*Method.* A further candidate is a whole run of 20 or more token characters. Its encoding is the
narrowest alphabet that holds it (hex, one-case letters, base32, base36, base62, base64). Two
questions are asked of it:

1.  Does it look uniform over that alphabet? Chi-squared of the symbol counts, the runs test on
    symbols above and below the middle, and the serial correlation of neighbours; the smallest of
    the three p-values, times three, must reach ``least_uniform``.
2.  Could ordinary text look so even by chance? Over one-case alphabets the token's likelihood as text
    is compared with what text of its length has; a hex token, whose text would be words over a to f
    with digits, must moreover have more letters than a number does. Over mixed-case alphabets the
    chi-squared statistic serves, which under text grows with the length times the alphabet's
    imbalance. So the p-value of this null is length-aware by itself. Within a document the Benjamini-Hochberg step keeps the rate
    of false discoveries at ``false_rate``.

What passes both is a ``random`` span. It may overlap base spans; those always stay. Numbers of
digits alone are not candidates.

Positions count code points, ends are exclusive. They come from the lengths of matches and of the
pieces between them, as rows of one document, so a document with many matches needs no growing
array. Defined results: null text is empty, texts without spans give zeros and empty strings;
repeated rows each get their own result; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame, Window, functions as F

# Kinds in their order, their patterns, and the least length of the given group.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
BASE = (
    ("assign", ASSIGN, 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Per cent of the letters a to z in running English text.
LETTER_PERCENT = (
    8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4,
    6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074,
)


def _text_over(alphabet: str, letters: float) -> tuple[float, ...]:
    """How often text has each symbol of an alphabet: ``letters`` of all are letters, digits alike."""
    weight = [LETTER_PERCENT[_LOWER.index(c.lower())] if c.isalpha() else 0.0 for c in alphabet]
    digits = sum(c.isdigit() for c in alphabet)
    share = letters if digits else 1.0
    return tuple(w / sum(weight) * share if w else (1 - share) / digits for w in weight)


# Narrowest first: alphabet, how uneven text over it is (size * sum(p^2) - 1, with the letter
# frequencies of running text in one case), and, for alphabets in which single letters tell, the
# frequencies themselves. Hex texts are words over a to f, and digits.
TEXT_EVENNESS = 0.0655
ALPHABETS = (
    (_DIGITS + "abcdef", 0.0, _text_over(_DIGITS + "abcdef", 0.8)),
    (_DIGITS + "ABCDEF", 0.0, _text_over(_DIGITS + "ABCDEF", 0.8)),
    (_LOWER, 0.0, _text_over(_LOWER, 1.0)),
    (_UPPER, 0.0, _text_over(_UPPER, 1.0)),
    (_UPPER + "234567", 0.0, _text_over(_UPPER + "234567", 0.97)),
    (_LOWER + _DIGITS, 0.0, _text_over(_LOWER + _DIGITS, 0.97)),
    (_UPPER + _LOWER + _DIGITS, 62 * TEXT_EVENNESS - 1, ()),
    (_UPPER + _LOWER + _DIGITS + "+/", 64 * TEXT_EVENNESS - 1, ()),
    (_UPPER + _LOWER + _DIGITS + "-_", 64 * TEXT_EVENNESS - 1, ()),
)
# Letters in a number that holds some, such as a part number; more than that is no number.
NUMBER_LETTERS = 0.05
LEAST_UNIFORM = 0.001
FALSE_RATE = 0.01


def _first(cases: list[tuple[Column, Column]]) -> Column:
    return reduce(lambda c, x: c.when(*x), cases[1:], F.when(*cases[0]))


def normal_below(z: Column) -> Column:
    """The standard normal distribution function (Abramowitz and Stegun 26.2.17)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    series = t * (
        0.319381530
        + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))
    )
    tail = F.exp(-z * z / 2) / F.lit((2 * 3.141592653589793) ** 0.5) * series
    return F.when(z > 0, 1 - tail).otherwise(tail)


def _two_sided(z: Column) -> Column:
    return 2 * normal_below(-F.abs(z))


def _total(values: Column, term) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + term(x))


def tested(tokens: DataFrame) -> DataFrame:
    """Adds ``p_uniform`` and ``p_text`` to rows with ``token``; both null for other encodings."""
    body = F.rtrim("token", F.lit("="))
    # A token of digits alone is hex too, but a number.
    number = F.translate(body, _DIGITS, "") == ""
    holds = [F.translate(body, alphabet, "") == "" for alphabet, *_ in ALPHABETS]

    def of_alphabet(kind: str, value) -> Column:
        return _first([(number, F.lit(None).cast(kind))] + [(h, value(*a)) for h, a in zip(holds, ALPHABETS)])

    logs = of_alphabet("array<double>", lambda a, u, p: F.array(*[F.lit(log(x)) for x in p]).cast("array<double>"))
    mean = of_alphabet("double", lambda a, u, p: F.lit(sum(x * log(x) for x in p)))
    square = of_alphabet("double", lambda a, u, p: F.lit(sum(x * log(x) ** 2 for x in p)))
    rows = tokens.withColumns(
        {
            "_body": body,
            "_alphabet": of_alphabet("string", lambda a, u, p: F.lit(a)),
            "_uneven": of_alphabet("double", lambda a, u, p: F.lit(u)),
            "_logs": logs,
            "_log_mean": mean.cast("double"),
            "_log_square": square.cast("double"),
        }
    )
    symbols = F.split("_body", "")
    rows = rows.withColumns(
        {
            "_n": F.char_length("_body").cast("double"),
            "_k": F.char_length("_alphabet").cast("double"),
            "_x": F.transform(symbols, lambda c: F.instr(F.col("_alphabet"), c).cast("double")),
            "_squares": _total(
                F.array_distinct(symbols),
                lambda c: F.pow(F.col("_n") - F.char_length(F.replace(F.col("_body"), c, F.lit(""))), 2),
            ),
        }
    )
    n, k = F.col("_n"), F.col("_k")
    rows = rows.withColumns(
        {
            "_chi": k / n * F.col("_squares") - n,
            "_high": F.transform("_x", lambda x: x > F.col("_k") / 2),
            "_next": F.slice(F.col("_x"), F.lit(2), F.size("_x")),
            "_mean": _total(F.col("_x"), lambda x: x) / n,
        }
    )
    ones = F.size(F.filter("_high", lambda h: h)).cast("double")
    turns = F.size(
        F.filter(
            F.zip_with(
                F.col("_high"),
                F.slice(F.col("_high"), F.lit(2), F.size("_high")),
                lambda a, b: a != b,
            ),
            lambda t: t,
        )
    ).cast("double")
    rows = rows.withColumns({"_ones": ones, "_runs": turns + 1})
    zeros = n - F.col("_ones")
    both = 2 * F.col("_ones") * zeros
    spread = both * (both - n) / (n * n * (n - 1))
    z_runs = F.when(spread > 0, (F.col("_runs") - both / n - 1) / F.sqrt(spread))
    mean = F.col("_mean")
    pairs = F.zip_with(F.col("_x"), F.col("_next"), lambda a, b: (a - mean) * (b - mean))
    covariance = _total(F.filter(pairs, lambda p: p.isNotNull()), lambda p: p)
    variance = _total(F.col("_x"), lambda x: (x - mean) * (x - mean))
    z_serial = F.when(variance > 0, (covariance / variance + 1 / n) * F.sqrt(n))
    freedom = k - 1
    # Wilson and Hilferty: the cube root of chi-squared is nearly normal.
    part = 2 / (9 * freedom)
    z_chi = (F.pow(F.col("_chi") / freedom, 1 / 3) - (1 - part)) / F.sqrt(part)
    worst = F.least(
        normal_below(-z_chi),
        F.coalesce(_two_sided(z_runs), F.lit(0.0)),
        F.coalesce(_two_sided(z_serial), F.lit(0.0)),
    )
    # Under text single symbols are as likely as in text; a random token has too many rare ones.
    found = _total(F.col("_x"), lambda x: F.element_at(F.col("_logs"), x.cast("int")))
    log_spread = F.sqrt((F.col("_log_square") - F.col("_log_mean") * F.col("_log_mean")) * n)
    p_letters = normal_below((found - n * F.col("_log_mean")) / log_spread)
    # A number with few letters in it is neither text nor random.
    letters = F.char_length(F.translate("_body", _DIGITS, "")).cast("double")
    few = NUMBER_LETTERS
    p_number = F.when(
        k == 16, normal_below((n * few - letters) / F.sqrt(n * few * (1 - few)))
    ).otherwise(0.0)
    text_mean = freedom + n * F.col("_uneven")
    text_spread = F.sqrt(2 * freedom + 4 * n * F.col("_uneven"))
    rows = rows.withColumns(
        {
            "p_uniform": F.when(F.col("_alphabet").isNotNull(), F.least(3 * worst, F.lit(1.0))),
            "p_text": F.when(F.size("_logs") > 0, F.greatest(p_letters, p_number)).otherwise(
                normal_below((F.col("_chi") - text_mean) / text_spread)
            ),
        }
    )
    return rows.drop(*[c for c in rows.columns if c.startswith("_") and c not in tokens.columns])


def _matches(text: Column, order: int, pattern: str, group: int) -> Column:
    """One struct per match: the length of what stands before it since the last, its own length,
    that of ``group``, and for candidates the match itself."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    between = F.split(text, pattern, -1)
    return F.when(
        F.size(whole) > 0,
        F.transform(
            F.arrays_zip(
                whole.alias("whole"), inner.alias("inner"), between.alias("between")
            ),
            lambda m: F.struct(
                F.lit(order).alias("kind"),
                F.char_length(m["between"]).alias("before"),
                F.char_length(m["whole"]).alias("length"),
                F.char_length(m["inner"]).alias("inner"),
                (m["whole"] if order == len(BASE) else F.lit(None).cast("string")).alias("token"),
            ),
        ),
    ).otherwise(F.array())


def find_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row, doc_id, kind, start, end``: one row per span, and one with null ``kind`` for a
    document without any match. ``kind`` is the place in ``assign, access, hex, random``."""
    found = F.flatten(
        F.array(
            *[_matches(F.col("text"), i, p, g) for i, (_, p, g, _) in enumerate(BASE)],
            _matches(F.col("text"), len(BASE), CANDIDATE, 0),
        )
    )
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    matches = rows.select("row", "doc_id", F.posexplode_outer(found).alias("place", "m"))
    matches = matches.select("row", "doc_id", "place", "m.*").repartition("row")
    so_far = Window.partitionBy("row", "kind").orderBy("place")
    end = F.sum(F.col("before") + F.col("length")).over(so_far)
    matches = matches.withColumn("end", end).withColumn("start", F.col("end") - F.col("length"))
    return tested(matches)


def random_spans(matches: DataFrame, least_uniform: float, false_rate: float) -> DataFrame:
    """Keeps what is a finding, by length or by the Benjamini-Hochberg step within the document."""
    by_chance = Window.partitionBy("row", "kind").orderBy(F.col("p_text").asc_nulls_last(), "place")
    all_of = Window.partitionBy("row", "kind")
    # A number or an unknown encoding is no test.
    tests = F.count("p_text").over(all_of)
    place = F.row_number().over(by_chance)
    ranked = matches.withColumns({"_rank": place, "_tests": tests})
    good = F.col("p_text") <= F.lit(false_rate) * F.col("_rank") / F.col("_tests")
    ranked = ranked.withColumn("_last", F.max(F.when(good, F.col("_rank"))).over(all_of))
    least = _first([(F.col("kind") == i, F.lit(n)) for i, (_, _, _, n) in enumerate(BASE)])
    base = (F.col("kind") < len(BASE)) & (F.col("inner") >= least)
    random = (
        (F.col("kind") == len(BASE))
        & F.col("p_text").isNotNull()
        & (F.col("_rank") <= F.col("_last"))
        & (F.col("p_uniform") >= least_uniform)
    )
    is_found = F.coalesce(base | random, F.lit(False))
    return ranked.withColumn("found", is_found).drop("_rank", "_tests", "_last")


def scan_secrets(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_uniform: float = LEAST_UNIFORM,
    false_rate: float = FALSE_RATE,
) -> DataFrame:
    """Per row ``doc_id``, an array ``spans`` of ``start, kind, end`` by start, then kind in order
    of ``names()``, where ``kind`` is its place in that list."""
    marked = random_spans(find_spans(docs, doc_id, text), least_uniform, false_rate)
    span = F.when(F.col("found"), F.struct("start", "kind", "end"))
    return marked.groupBy("row", "doc_id").agg(F.sort_array(F.collect_list(span)).alias("spans")).drop("row")


def names() -> list[str]:
    return [kind for kind, *_ in BASE] + ["random"]


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    name = F.array(*[F.lit(n) for n in names()])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )
