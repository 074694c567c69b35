"""Start dates in three spellings and ages in calendar months."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days first, and years first; other texts, placeholders included, are no date.
DAY_FIRST, YEAR_FIRST = r"^([0-9]{1,2})([-/])([0-9]{1,2})\2([0-9]{4})\z", r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"


def parse_date(text: Column) -> Column:
    """Date of a clean text, null when it is a placeholder or in no known spelling.

    The shape is tested first, so that the date parser (which signals failure by
    an exception per row) only sees texts of its own format. The text stands here
    once: a filter that moves below the projection that makes the text would make
    it again for every mention.
    """
    year_first = F.regexp_replace(text, DAY_FIRST, "$4-$3-$1")
    return F.try_to_date(F.get(F.regexp_extract_all(year_first, F.lit(YEAR_FIRST), F.lit(0)), F.lit(0)), "yyyy-M-d")


def age_months(start: Column, as_of: date) -> Column:
    """Whole calendar months from a date column to ``as_of``; days do not count."""
    return F.lit(as_of.year * 12 + as_of.month) - (F.year(start) * 12 + F.month(start))


def first_young_day(as_of: date, max_months: int) -> date:
    """The first start date whose age at ``as_of`` is at most ``max_months``.

    Ages count calendar months, so this is the first of a month; comparing dates
    with it needs no age per row.
    """
    month = as_of.year * 12 + as_of.month - 1 - max_months
    return date(month // 12, month % 12 + 1, 1) if month >= 12 else date.min
