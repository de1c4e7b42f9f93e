"""Scalar rules shared by the models: strict ISO dates and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The only accepted calendar-date text form (fixed value). Anything else --
# '', '2024', '2024-02-30' -- is not a date.
ISO_DATE = "yyyy-MM-dd"


def try_iso_date(text: Column) -> Column:
    """``try_to_date(text)`` restricted to ``yyyy-MM-dd``; NULL when invalid."""
    return F.try_to_date(text, ISO_DATE)


def strict_date(text: Column | str) -> Column:
    """``to_date(text)`` that raises on invalid input under ANSI mode (F8)."""
    c = F.lit(text) if isinstance(text, str) else text
    return F.to_date(c, ISO_DATE)


def iso_timestamp_ntz(text: Column) -> Column:
    """``to_timestamp_ntz(text)``: ISO-8601 text, an offset is dropped.

    Keeps the wall-clock time written in the text. Strict: raises on text
    that is not a timestamp.
    """
    return text.cast("timestamp_ntz")


# Python's isoformat() of an aware UTC datetime (fixed value).
ISO_UTC_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def utc_now_iso() -> Column:
    """F10 first half: the current UTC time as ISO-8601 text with ``+00:00``.

    Evaluated once per query (``current_timestamp`` is fixed for a query),
    so every row of one load carries the same stamp. Needs a UTC session.
    """
    return F.date_format(F.current_timestamp(), ISO_UTC_TEXT)


def utc_today_iso() -> Column:
    """F10 second half: the current UTC date as ``yyyy-MM-dd`` text."""
    return F.date_format(F.current_date(), ISO_DATE)
