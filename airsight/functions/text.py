"""Text expressions: Unicode-aware strip and whitespace collapse, templates, token estimates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All Unicode white space (a fixed value; Java's ``\\s`` covers ASCII only).
WHITESPACE = r"\s\x{1c}-\x{1f}\x{85}\p{Z}"


#: The same characters one by one, for trimming (a fixed value).
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE_CHARS))


def has_content(text: Column) -> Column:
    """True if anything but white space is present; one linear scan."""
    return F.rlike(text, F.lit(rf"[^{WHITESPACE}]"))


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, rf"[{WHITESPACE}]+", " "))


def capitalize(text: Column) -> Column:
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substring(text, 2, 2147483647)))


def token_estimate(text: Column) -> Column:
    return F.greatest(F.lit(1).cast("bigint"), F.floor(F.length(text) / 4))


def fixed(value: Column, digits: int) -> Column:
    """Number text with a fixed count of decimals; rounds first so that ties never differ."""
    return F.format_string(f"%.{digits}f", F.round(value, digits))


def fill(template: str, **values: Column) -> Column:
    """Replace ``{name}`` in a template by column values."""
    parts: list[Column] = []
    rest = template
    while rest:
        head, brace, tail = rest.partition("{")
        if head:
            parts.append(F.lit(head))
        if not brace:
            break
        name, _, rest = tail.partition("}")
        parts.append(values[name])
    return F.concat(*parts)
