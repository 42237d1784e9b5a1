"""Date and time expressions.

All parsing uses the ``try_`` functions: under ANSI mode the plain ones abort
the job on the very rows the filters are there to drop.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.params import DATE_FORMAT


def parse_time(text: Column, fmt: str, time_zone: str | None = None) -> Column:
    """Timestamp, or null where ``text`` does not follow ``fmt``.

    A quoted zone letter in ``fmt`` is plain text to Spark, so the value is read
    in the session's zone. With ``time_zone`` the zone id is appended to both
    text and pattern, which makes the result independent of the session.
    """
    if time_zone is None:
        return F.try_to_timestamp(text, F.lit(fmt))
    return F.try_to_timestamp(
        F.concat(text, F.lit(f" {time_zone}")), F.lit(f"{fmt} VV")
    )


def parse_date(text: Column, fmt: str = DATE_FORMAT) -> Column:
    """Date, or null where ``text`` does not follow ``fmt``."""
    return F.try_to_date(text, fmt)


def date_part_of(text: Column) -> Column:
    """Text before the first ``T``."""
    return F.get(F.split(text, "T"), F.lit(0))


def time_part_of(text: Column) -> Column:
    """Text between the first ``T`` and the next ``Z``; null without a ``T``."""
    return F.get(F.split(F.get(F.split(text, "T"), F.lit(1)), "Z"), F.lit(0))


def hours_between(
    start: Column, end: Column, fmt: str, time_zone: str | None = None
) -> Column:
    """Hours from ``start`` to ``end`` as double; negative if they are swapped."""
    seconds = F.unix_timestamp(parse_time(end, fmt, time_zone)) - F.unix_timestamp(
        parse_time(start, fmt, time_zone)
    )
    return seconds / F.lit(3600)


def tenure_days(signup: Column, as_of_date: str | None = None) -> Column:
    """Whole days from ``signup`` to ``as_of_date`` (default: the run day)."""
    end = F.current_date() if as_of_date is None else F.lit(as_of_date).cast("date")
    return F.date_diff(end, signup)
