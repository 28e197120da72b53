"""Text helpers: whitespace, defaults, templates, percent-decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters counted as white space in file names and replies.
# Java's \s misses several of them, U+FEFF even in Unicode mode.
WHITESPACE = r"\t\n\x0B\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"


def dash_whitespace(text: Column) -> Column:
    """Each run of white space becomes one dash."""
    return F.regexp_replace(text, f"[{WHITESPACE}]+", "-")


def is_blank(text: str) -> str:
    """SQL: nothing but white space."""
    return f"regexp_replace({text}, r'[{WHITESPACE}]+', '') = ''"


def or_default(text: Column, default: str) -> Column:
    """``default`` for null and for the empty text."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def shown(value: Column) -> Column:
    """A value inside a text template: null is shown as the word, not spread to the whole text."""
    return F.coalesce(value.cast("string"), F.lit("null"))


def percent_decode(text: Column) -> Column:
    """Percent-decoding that leaves ``+`` alone; null for malformed input.

    The built-in turns ``+`` into a space and malformed UTF-8 into U+FFFD.
    """
    decoded = F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    spoiled = decoded.contains("\ufffd") & ~text.contains("\ufffd") & ~F.upper(text).contains("%EF%BF%BD")
    return F.when(~spoiled, decoded)
