"""The second scorer: leads with missing contacts rank higher."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscout.functions.dates import parse_date
from firmscout.functions.scores import gap_rules, points, reasons
from firmscout.functions.sectors import allowed_sector, sector_of
from firmscout.functions.text import is_missing, strip
from firmscout.operators.joins import ORDER
from firmscout.plans.params import DEFAULT_MONTHS


def score_gaps(df: DataFrame, as_of: datetime, months: int = DEFAULT_MONTHS) -> DataFrame:
    """Add ``sector``, ``score_total`` and ``score_reasons`` to any frame of companies.

    Columns ``start_date``, ``sector``, ``nace``, ``phone`` and ``email`` are used
    if the frame has them. A sector is checked, or else found by code; the start
    must not lie before ``as_of`` less the months, to the second.
    """
    has = set(df.columns)
    if "sector" in has:
        sector = allowed_sector(F.col("sector"))
    else:
        sector = sector_of(F.col("nace")) if "nace" in has else F.lit("other")
    since = F.lit(as_of).cast("timestamp_ntz") - F.make_interval(months=F.lit(months))
    if "start_date" in has:
        recent = parse_date(strip(F.col("start_date"))).cast("timestamp_ntz") >= since
    else:
        recent = F.lit(False)
    missing = {c: is_missing(F.col(c)) if c in has else None for c in ("phone", "email", "nace")}
    out = df.withColumn("sector", sector)
    rules = gap_rules(recent, months, F.col("sector"), missing["phone"], missing["email"], missing["nace"])
    return out.withColumn("score_total", points(rules)).withColumn("score_reasons", reasons(rules))


def by_gap_score(df: DataFrame) -> DataFrame:
    """Highest score first, file order among equals."""
    return df.orderBy(F.desc("score_total"), ORDER)
