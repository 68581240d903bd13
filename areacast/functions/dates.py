"""Date expressions: tolerant parsing and the year-week keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from areacast.fixed import DATE_KEY


def parse_date(value: Column, fmt: str) -> Column:
    """Text -> date by format; text that does not fit gives null."""
    return F.try_to_timestamp(value, F.lit(fmt)).cast("date")


def date_key(day: Column) -> Column:
    """Date -> ``yyyy/MM/dd HH:mm:ss`` text."""
    return F.date_format(day, DATE_KEY)


def _key(year: Column, week: Column, as_text: bool) -> Column:
    if as_text:
        return F.concat(year.cast("string"), F.lpad(week.cast("string"), 2, "0"))
    return (year * 100 + week).cast("int")


def week_key_iso(day: Column, as_text: bool = False) -> Column:
    """``YYYYWW`` where the year is the one the ISO week belongs to."""
    return _key(F.extract(F.lit("YEAROFWEEK"), day), F.weekofyear(day), as_text)


def week_key_calendar(day: Column, as_text: bool = False) -> Column:
    """``YYYYWW`` of calendar year and ISO week: 2016-01-01 gives 201653."""
    return _key(F.year(day), F.weekofyear(day), as_text)
