"""ISO-8601 text to and from millisecond timestamps (session time zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted ISO-8601 shapes, their looser spellings, and the rendered shape.
ISO_PATTERN = (
    r"^\d{4}(-\d{2}(-\d{2})?)?$"
    r"|^\d{4}(-\d{2}(-\d{2})?)?T\d{2}:\d{2}(:\d{2}([.]\d+)?)?(Z|[+-]\d{2}:\d{2})?$"
)
SPACED_PATTERN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.]\d+)?)? ?(Z|GMT|UTC|[+-]\d{2}:?\d{2})?$"
MAIL_PATTERN = (
    r"^((Mon|Tue|Wed|Thu|Fri|Sat|Sun), )?\d{1,2} (Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) \d{4}"
    r" \d{2}:\d{2}:\d{2} (GMT|UTC|[+-]\d{4})$"
)
USUAL_SHAPE = "0000-00-00T00:00:00.000Z"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def iso_millis(ts: Column) -> Column:
    """Render a timestamp as ``2026-04-24T15:30:00.000Z``; microseconds are cut, not rounded."""
    return F.date_format(ts, ISO_FORMAT)


def parse_iso(text: str) -> str:
    """SQL for a date text to a timestamp cut to milliseconds; anything else is null.

    Read are ISO text; the same with a blank for the T, a zone without its colon
    or a named one; and the dates of mail headers.  A text without a zone is UTC.

    A bare cast is too generous (``'15:30:00'`` becomes today) and too strict
    (no seconds is refused), hence the shape check and the inserted ``:00``.
    The shape that ``iso_millis`` writes is recognised without a regular
    expression, since nearly every row has it.
    """
    seconds = r"r'(T\d{2}:\d{2})($|Z|[+-])', '$1:00$2'"
    blank, named, colon = r"r'^(.{10}) ', '$1T'", r"r' ?(GMT|UTC)$', 'Z'", r"r' ?([+-]\d{2}):?(\d{2})$', '$1:$2'"
    spaced = f"regexp_replace(regexp_replace(regexp_replace({text}, {blank}), {named}), {colon})"
    weekday, zone = r"r'^[A-Z][a-z]{2}, ', ''", r"r' (GMT|UTC)$', ' +0000'"
    mail = f"regexp_replace(regexp_replace({text}, {weekday}), {zone})"
    return f"""CASE
        WHEN translate({text}, '123456789', '000000000') = '{USUAL_SHAPE}' THEN try_cast({text} AS TIMESTAMP)
        WHEN {text} RLIKE r'{ISO_PATTERN}' THEN date_trunc('MILLISECOND',
            try_cast(regexp_replace({text}, {seconds}) AS TIMESTAMP))
        WHEN {text} RLIKE r'{SPACED_PATTERN}' THEN date_trunc('MILLISECOND',
            try_cast(regexp_replace({spaced}, {seconds}) AS TIMESTAMP))
        WHEN {text} RLIKE r'{MAIL_PATTERN}' THEN try_to_timestamp({mail}, 'd MMM yyyy HH:mm:ss Z') END"""
