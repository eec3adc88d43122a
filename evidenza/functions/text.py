"""String helpers as Column expressions (no Python runs per row)."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\r\n\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    A Column used several times inside ``body``, above all inside a lambda,
    would otherwise be evaluated at every place it appears.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(col: Column) -> Column:
    """Trim whitespace at both ends; SQL ``trim`` alone removes only spaces."""
    return F.btrim(col, F.lit(WHITESPACE))


def empty_to_null(col: Column) -> Column:
    return F.when(col != "", col)


def capitalize(col: Column) -> Column:
    """First letter upper, all others lower (``initcap`` works per word)."""
    return F.concat(F.upper(F.left(col, F.lit(1))), F.lower(F.substr(col, F.lit(2))))


def title_case(col: Column) -> Column:
    """Capital after a blank and after a hyphen: ``costa-rica`` -> ``Costa-Rica``."""
    return F.array_join(F.transform(F.split(col, "-"), F.initcap), "-")


def label_title(label: Column) -> Column:
    """``net_zero_target`` -> ``Net Zero Target``."""
    return F.initcap(F.replace(label, F.lit("_"), F.lit(" ")))


def fixed(value: Column, places: int) -> Column:
    """Fixed number of decimals, rounded as the binary number really is.

    ``format_string`` rounds the shortest decimal text of a number, so that a
    double just below a half is rounded up.  Here the distance to the half is
    taken without rounding error: the number is split into two parts whose
    products with the scale are exact.  True halves go to the even neighbour.
    """
    value = value.cast("double")
    scale = 10.0**places
    high = F.rint(value * 2.0**26) / F.lit(2.0**26)
    below = F.floor(value * scale).cast("double")
    past_half = (high * (2 * scale) - (2 * below + 1)) + (value - high) * (2 * scale)
    up = (past_half > 0) | ((past_half == 0) & (below % 2 != 0))
    units = below + F.when(up, 1.0).otherwise(0.0)
    return F.when(value.isNotNull(), F.format_string(f"%.{places}f", units / F.lit(scale)))


def number_text(value: Column, places: int) -> Column:
    """Shortest text of a number with at most ``places`` decimals: ``0.831``, ``1.0``."""
    return F.regexp_replace(fixed(value, places), r"(\.\d+?)0+$", "$1")


def drop_first(values: Column) -> Column:
    """Array without its first element."""
    return F.slice(values, F.lit(2), F.size(values))


def contains_ignoring_case(col: Column, part: str) -> Column:
    return F.contains(F.lower(col), F.lit(part.lower()))


def document_id(country: Column, language: Column, day: Column) -> Column:
    """``country_lang_yyyymmdd`` in lower case with ``_`` for blanks."""

    def part(col: Column) -> Column:
        return F.replace(F.lower(F.coalesce(col, F.lit("unknown"))), F.lit(" "), F.lit("_"))

    date = F.coalesce(F.date_format(day, "yyyyMMdd"), F.lit("unknown_date"))
    return F.concat_ws("_", part(country), part(language), date)


def london_time(instant: Column) -> Column:
    """Wall-clock time in London of a UTC instant."""
    return F.from_utc_timestamp(instant, "Europe/London")


def decode_entities(col: Column) -> Column:
    """Replace HTML character references: named ones and ``&#233;`` / ``&#xe9;``.

    A number that is no character (0, a surrogate, too large) gives U+FFFD.

    ``&amp;`` goes last, so ``&amp;lt;`` ends as ``&lt;`` and not as ``<``.
    """
    table = {name: char for name, char in html5.items() if name.endswith(";")}
    # one constant, folded to a map when the plan is optimised
    names = F.from_json(F.lit(json.dumps(table)), "map<string,string>")
    ampersand = F.lit(r"&(?:amp|#38|#[xX]26);")

    # numbers of the old Windows page mean its characters, as browsers have it
    windows = {b: bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
    moved = F.create_map(*[F.lit(x) for b, c in windows.items() if c for x in (b, ord(c))])

    def code_point(body: Column) -> Column:
        is_hex = body.rlike("^#[xX]")
        digits = F.regexp_extract(body, "^#[xX]?0*([0-9a-fA-F]*);$", 1)
        number = F.when(is_hex, F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10))
        # longer numbers are beyond the last code point in any case
        code = F.when(F.length(digits).between(1, 7), number.cast("bigint"))
        real = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        chosen = F.when(real, F.coalesce(F.try_element_at(moved, code.cast("int")), code)).otherwise(0xFFFD)
        wide = F.lpad(F.hex(chosen.cast("bigint")), 8, "0")
        return F.when(body.rlike("^#([0-9]+|[xX][0-9a-fA-F]+);$"), F.decode(F.unhex(wide), "UTF-32"))

    def replace_one(text: Column, ref: Column) -> Column:
        body = F.substr(ref, F.lit(2))
        char = F.coalesce(F.try_element_at(names, body), code_point(body), ref)
        return F.replace(text, ref, char)

    reference = F.lit(r"(&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);)")

    def decode(text: Column) -> Column:
        refs = F.array_distinct(F.regexp_extract_all(text, reference, F.lit(1)))
        refs = F.filter(refs, lambda ref: ~ref.rlike("^&(?:amp|#38|#[xX]26);$"))
        decoded = F.regexp_replace(F.aggregate(refs, text, replace_one), ampersand, F.lit("&"))
        return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)

    return let(col, decode)
