"""Zone-free dates and timestamps."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F, types as T

# Month and weekday names are blank-padded to this width.
NAME_WIDTH = 9


def now() -> datetime:
    """The time in UTC, without a zone."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


# A year, a month and a day, and perhaps a time; a plain cast would complete a partial date.
_FULL_DATE = r"^\s*[+-]?\d+-\d{1,2}-\d{1,2}(?:[ T].*)?$"


def wall_clock(text: Column) -> Column:
    """Text to a timestamp without zone, so no local time is ever shifted.

    Fails on text that is no full date or has anything after it.
    """
    refused = F.raise_error(F.concat(F.lit("not a full date: "), text)).cast(T.TimestampNTZType())
    return F.when(text.isNull() | text.rlike(_FULL_DATE), text.cast(T.TimestampNTZType())).otherwise(refused)


def wall_clock_or_null(text: Column) -> Column:
    """NULL where :func:`wall_clock` fails."""
    return F.when(text.rlike(_FULL_DATE), text.try_cast(T.TimestampNTZType()))


def calendar_date(text: Column) -> Column:
    """The date of a timestamp text. A direct date cast would accept trailing garbage."""
    return wall_clock(text).cast(T.DateType())


def midnight(text: Column) -> Column:
    return calendar_date(text).cast(T.TimestampNTZType())


def iso_weekday(date: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(date) + 1


def month_name(date: Column) -> Column:
    return F.rpad(F.date_format(date, "MMMM"), NAME_WIDTH, " ")


def day_name(date: Column) -> Column:
    return F.rpad(F.date_format(date, "EEEE"), NAME_WIDTH, " ")


def whole_days(start: Column, end: Column) -> Column:
    """Complete 24-hour periods from start to end, toward zero; not calendar days."""
    return F.extract(F.lit("DAY"), end - start).cast(T.IntegerType())
