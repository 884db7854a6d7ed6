"""HTML5 character-reference decoding as a Catalyst expression.

The result equals the Python standard library's ``html.unescape``. It stays in the JVM, so it also
works inside ``transform`` / ``filter`` lambdas, where a Python UDF cannot be called.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, functions as F

_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_PIECE = _REFERENCE + r"|&|[^&]+"
_TOO_BIG = 0x110000


def _windows_1252(byte: int) -> str:
    try:
        return bytes([byte]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(byte)


# Code points that decode to nothing, and those read as windows-1252.
_NOTHING = (
    r"[\x01-\x08\x0b\x0e-\x1f\x7f\x{fdd0}-\x{fdef}"
    + "".join(rf"\x{{{plane:x}fffe}}\x{{{plane:x}ffff}}" for plane in range(17))
    + "]"
)
_C1_CODES = "".join(map(chr, range(0x80, 0xA0)))
_C1 = "".join(_windows_1252(b) for b in range(0x80, 0xA0))
_TABLE = "\x02".join(f"{name}\x01{value}" for name, value in html5.items())
_BARE = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _numeric(piece: Column) -> Column:
    digits = F.regexp_extract(piece, r"^&#[xX]?0*([0-9a-fA-F]*)", 1)
    is_hex = piece.rlike("^&#[xX]")

    def code(d: Column) -> Column:
        value = F.when(is_hex, F.conv(d, 16, 10)).otherwise(F.conv(d, 10, 10))
        return F.when(F.length(d) > F.when(is_hex, 6).otherwise(7), str(_TOO_BIG)).otherwise(value)

    def character(n: Column) -> Column:
        bad = (n == 0) | (n >= _TOO_BIG) | n.between(0xD800, 0xDFFF)
        plain = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return F.when(bad, "\ufffd").otherwise(plain)

    one = bind(F.coalesce(bind(digits, code).cast("int"), F.lit(0)), character)
    return F.translate(F.regexp_replace(one, _NOTHING, ""), _C1_CODES, _C1)


def _named(piece: Column) -> Column:
    table = F.str_to_map(F.lit(_TABLE), F.lit("\x02"), F.lit("\x01"))
    name = F.substring(piece, F.lit(2), F.length(piece))
    prefix = F.regexp_extract(name, f"^({_BARE})", 1)

    def by_prefix(p: Column) -> Column:
        rest = F.substring(name, F.length(p) + 1, F.length(name))
        return F.when(p == "", piece).otherwise(F.concat(F.try_element_at(table, p), rest))

    return (
        F.when(name == "amp;", "&")
        .when(name == "lt;", "<")
        .when(name == "gt;", ">")
        .when(name == "quot;", '"')
        .when(name == "nbsp;", "\xa0")
        .otherwise(F.coalesce(F.try_element_at(table, name), bind(prefix, by_prefix)))
    )


def unescape(text: Column) -> Column:
    """Decode every character reference once, left to right."""

    def piece_value(piece: Column) -> Column:
        plain = ~piece.startswith("&") | (F.length(piece) == 1)
        return (
            F.when(plain, piece).when(piece.startswith("&#"), _numeric(piece)).otherwise(_named(piece))
        )

    pieces = F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0))
    decoded = F.array_join(F.transform(pieces, piece_value), "")
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)
