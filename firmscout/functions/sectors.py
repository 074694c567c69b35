"""Activity codes and the sector they belong to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmscout.functions.text import strip

# Code prefixes and their sector; the longest prefix comes first.
SECTOR_PREFIXES = [
    ("96.02", "beauty"),
    ("56", "horeca"),
    ("86", "health"),
    ("47", "retail"),
    ("43", "service_trades"),
    ("81", "service_trades"),
    ("95", "service_trades"),
]
# The sectors a lead may carry, and those that earn points.
SECTORS = ["beauty", "horeca", "health", "retail", "service_trades", "other"]
HIGH_VALUE_SECTORS = ["beauty", "horeca", "health"]


def activity_code(code: Column) -> Column:
    """Code in comparable form: stripped, upper case, dots instead of commas."""
    return F.replace(F.upper(strip(code)), F.lit(","), F.lit("."))


def sector_of(code: Column, prefixes: list[tuple[str, str]] | None = None) -> Column:
    """Sector by code prefix, ``other`` when no prefix fits or there is no code."""
    comparable = activity_code(code)
    rules = SECTOR_PREFIXES if prefixes is None else prefixes
    return F.coalesce(
        *[F.when(comparable.startswith(prefix), F.lit(sector)) for prefix, sector in rules],
        F.lit("other"),
    )


def allowed_sector(sector: Column) -> Column:
    """A sector from outside, kept if it is one of ours, else ``other``."""
    name = F.lower(strip(sector))
    return F.when(name.isin(SECTORS), name).otherwise(F.lit("other"))


def is_high_value(sector: Column) -> Column:
    return F.coalesce(sector.isin(HIGH_VALUE_SECTORS), F.lit(False))
