"""Date scalars. Parsing works by a guarding pattern and ``try_make_timestamp``: a bad value gives
null and no formatter exception is ever raised, which matters when most of a column is junk."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from ledgerloom.functions.entities import bind

# The accepted shapes of a publication date, in the order they are tried.
COMPAT_FORMATS: tuple[str, ...] = (
    "%a, %d %b %Y %H:%M:%S %Z",
    "%a, %d %b %Y %H:%M:%S GMT",
    "%Y-%m-%dT%H:%M:%S%z",
    "%Y-%m-%dT%H:%M:%S",
    "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%d",
)

# The two further shapes that feeds and isoformat() really write.
DEFAULT_FORMATS = COMPAT_FORMATS + ("%Y-%m-%dT%H:%M:%S.%f", "%a, %d %b %Y %H:%M:%S %z")

_WS = r"[\t\n\x0b\f\r\x1c-\x1f\x85\p{Z}]"
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
# directive -> (pattern, name of the group or None)
_DIRECTIVES = {
    "a": ("(?:mon|tue|wed|thu|fri|sat|sun)", None),
    "d": ("(3[01]|[12][0-9]|0?[1-9])", "day"),
    "b": ("(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)", "month_name"),
    "m": ("(1[0-2]|0?[1-9])", "month"),
    "Y": ("([0-9]{4})", "year"),
    "H": ("(2[0-3]|[01]?[0-9])", "hour"),
    "M": ("([0-5]?[0-9])", "minute"),
    "S": ("([0-5]?[0-9])", "second"),
    "f": ("([0-9]{1,6})", "fraction"),
    "Z": ("(?:gmt|utc)", None),
    "z": ("((?-i:Z)|[+-](?:[01][0-9]|2[0-3]):?[0-5][0-9])", "offset"),
}


# The order in which a matched value's fields are written down before they become an instant.
_FIELDS = ("year", "month", "day", "hour", "minute", "second", "fraction", "offset")


def format_pattern(fmt: str) -> tuple[str, dict[str, int]]:
    """The pattern a ``strptime`` format accepts, and its group numbers by field."""
    out, groups = "", {}
    for directive, literal in re.findall(r"%(.)|([^%])", fmt):
        if directive:
            piece, name = _DIRECTIVES[directive]
            if name:
                groups[name] = len(groups) + 1
            out += piece
        elif literal == " ":
            out += f"{_WS}+"
        else:
            out += re.escape(literal)
    return rf"(?i)^{out}\z", groups


def _fields(text: Column, number: int, fmt: str) -> Column:
    """``number|year|month|…`` if ``text`` has the shape of ``fmt``, else null."""
    pattern, groups = format_pattern(fmt)
    line = "|".join([str(number), *[f"${groups[f]}" if f in groups else "" for f in _FIELDS]])
    return F.when(text.rlike(pattern), F.regexp_replace(text, pattern, line))


def _instant(parts: Column) -> Column:
    """The instant of split ``number|year|month|…`` fields, null if there is no such day."""

    def part(field: str) -> Column:
        return parts[_FIELDS.index(field) + 1]

    def whole(field: str) -> Column:
        return F.coalesce(part(field).try_cast("int"), F.lit(0))

    month = part("month")
    by_name = ((F.instr(F.lit(_MONTHS), F.lower(month)) + 2) / 3).cast("int")
    second = F.concat(F.lpad(part("second"), 2, "0"), F.lit("."), F.rpad(part("fraction"), 6, "0"))
    local = F.try_make_timestamp(
        F.nullif(whole("year"), F.lit(0)),
        F.coalesce(month.try_cast("int"), by_name),
        whole("day"),
        whole("hour"),
        whole("minute"),
        second.cast("decimal(16,6)"),
        F.lit("UTC"),
    )
    digits = F.regexp_replace(part("offset"), "[^0-9]", "")
    hhmm = F.rpad(digits, 4, "0").cast("int")
    ahead = (F.floor(hhmm / 100) * 3600 + hhmm % 100 * 60) * 1_000_000
    signed = F.when(part("offset").startswith("-"), -ahead).otherwise(ahead)
    return F.timestamp_micros(F.unix_micros(local) - signed)


def parse_published(text: Column, formats: Sequence[str] = DEFAULT_FORMATS) -> Column:
    """``struct<ts timestamp, fmt string>`` by the first format whose shape fits, else null.

    Each format costs one pattern test until one fits; the fields are turned into an instant once.
    Zone-less values are read as UTC, so all results are comparable instants.
    """
    found = F.coalesce(*[_fields(text, i, fmt) for i, fmt in enumerate(formats)])
    names = F.array(*[F.lit(f) for f in formats])

    def dated(parts: Column) -> Column:
        fmt = F.get(names, parts[0].cast("int"))
        stamped = bind(
            _instant(parts),
            lambda ts: F.when(ts.isNotNull(), F.struct(ts.alias("ts"), fmt.alias("fmt"))),
        )
        return F.when(parts.isNotNull(), stamped)

    return bind(F.split(found, r"\|"), dated)


def parse_date(text: Column, date_format: str = "d/M/yyyy") -> Column:
    """Midnight timestamp of a numeric date such as ``d/M/yyyy`` or ``yyyy-MM-dd``, else null."""
    pieces = {"dd": "([0-9]{2})", "d": "([0-9]{1,2})", "MM": "([0-9]{2})", "M": "([0-9]{1,2})",
              "yyyy": "([0-9]{4})"}
    pattern, order, between = "", [], []
    for token, literal in re.findall(r"(dd?|MM?|yyyy)|(.)", date_format):
        if token:
            order.append(token[0])
            pattern += pieces[token]
        else:
            between.append(literal)
            pattern += re.escape(literal)
    pattern = rf"^{pattern}\z"
    # With one separator throughout, a field is read without running the pattern again.
    separator = between[0] if len(between) == 2 and between[0] == between[1] else None
    if sorted(order) != ["M", "d", "y"]:
        raise ValueError(f"date format needs one day, month and year: {date_format}")

    def field(letter: str) -> Column:
        place = order.index(letter) + 1
        if separator:
            return F.split_part(text, F.lit(separator), F.lit(place)).cast("int")
        return F.regexp_extract(text, pattern, place).cast("int")

    stamp = F.try_make_timestamp(
        F.nullif(field("y"), F.lit(0)), field("M"), field("d"),
        F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)"), F.lit("UTC"),
    )
    return F.when(text.rlike(pattern), stamp)


def iso_date(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyy-MM-dd")


def today(now: Column | None = None) -> Column:
    """Midnight at the start of the day of ``now``, by default the current day."""
    day = F.current_date() if now is None else F.to_date(now)
    return day.cast("timestamp")


def iso_now(now: Column | None = None) -> Column:
    """``now``, by default the current instant, as an ISO string with microseconds."""
    return F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def whole_days(first: Column, last: Column) -> Column:
    """Elapsed whole days between two instants; 23 hours across midnight are 0 days."""
    micros = F.unix_micros(last.cast("timestamp")) - F.unix_micros(first.cast("timestamp"))
    return F.floor(micros / F.lit(86_400_000_000)).cast("long")
