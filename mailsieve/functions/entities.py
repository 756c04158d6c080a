"""Decoding of HTML character references as one column expression.

Each reference is decoded once. Texts that hold only the handful of everyday
references take a chain of plain replacements; only texts with any other
reference are cut into pieces and decoded piece by piece.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everyday references. The ampersand comes last, so that what it
# produces is not read again.
EVERYDAY = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", "\xa0"),
    ("&amp;", "&"),
]

_OTHER_REFERENCE = r"&(?!(?:lt|gt|quot|#39|nbsp|amp);)(?:#[0-9xX]|[A-Za-z])"
_PIECES = r"&#[xX][0-9a-fA-F]+;?|&#[0-9]+;?|&[A-Za-z][A-Za-z0-9]*;?|[^&]+|&"
_BARE_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
_BARE_PREFIX = "^&(" + "|".join(_BARE_NAMES) + ")"


def _names() -> Column:
    # Folded to one map literal when the query is optimised.
    entries = "\x02".join(f"{name}\x01{value}" for name, value in html5.items())
    return F.str_to_map(F.lit(entries), F.lit("\x02"), F.lit("\x01"))


def _code_point(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _windows_1252(code: Column) -> Column:
    """Codes 128 to 159 stand for the Windows-1252 characters, where defined."""
    chars = "".join(
        bytes([b]).decode("cp1252", errors="ignore") or chr(b) for b in range(0x80, 0xA0)
    )
    return F.substring(F.lit(chars), (code - 127).cast("int"), F.lit(1))


def _numeric(code: Column) -> Column:
    replacement = F.lit("\ufffd")
    dropped = (
        code.between(0x1, 0x8)
        | (code == 0xB)
        | code.between(0xE, 0x1F)
        | (code == 0x7F)
        | code.between(0xFDD0, 0xFDEF)
        | (code.bitwiseAND(0xFFFE) == 0xFFFE)
    )
    return (
        F.when(code.isNull() | (code == 0) | (code > 0x10FFFF), replacement)
        .when(code.between(0xD800, 0xDFFF), replacement)
        .when(code.between(0x80, 0x9F), _windows_1252(code))
        .when(dropped, F.lit(""))
        .otherwise(_code_point(code))
    )


def _decode_piece(piece: Column) -> Column:
    names = _names()
    body = F.substring(piece, F.lit(2), F.length(piece))
    digits = F.regexp_extract(piece, r"^&#0*([0-9]*)", 1)
    hex_digits = F.regexp_extract(piece, r"^&#[xX]0*([0-9a-fA-F]*)", 1)
    # More than eight digits lie far above the last code point: null here.
    decimal = F.when(F.length(digits) <= 8, F.coalesce(digits.try_cast("bigint"), F.lit(0)))
    hexadecimal = F.when(
        F.length(hex_digits) <= 8,
        F.conv(F.concat(F.lit("0"), hex_digits), 16, 10).cast("bigint"),
    )
    bare = F.regexp_extract(piece, _BARE_PREFIX, 1)
    by_prefix = F.when(
        bare != "",
        F.concat(
            F.try_element_at(names, bare),
            F.substring(piece, F.length(bare) + 2, F.length(piece)),
        ),
    )
    return (
        F.when(~piece.startswith("&") | (piece == "&"), piece)
        .when(piece.rlike("^&#[xX]"), _numeric(hexadecimal))
        .when(piece.startswith("&#"), _numeric(decimal))
        .otherwise(F.coalesce(F.try_element_at(names, body), by_prefix, piece))
    )


def decode_everyday(text: Column) -> Column:
    for reference, character in EVERYDAY:
        text = F.replace(text, F.lit(reference), F.lit(character))
    return text


def decode_entities(text: Column) -> Column:
    pieces = F.regexp_extract_all(text, F.lit(_PIECES), 0)
    return (
        F.when(~text.contains("&"), text)
        .when(text.rlike(_OTHER_REFERENCE), F.array_join(F.transform(pieces, _decode_piece), ""))
        .otherwise(decode_everyday(text))
    )
