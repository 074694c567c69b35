"""Validity of finished leads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmscout.functions.scores import SCORE_CEILING, SCORE_FLOOR
from firmscout.functions.text import blank, strip

# The shape of a valid postcode.
POSTCODE_SHAPE = "^[0-9]{4}$"

REASON = "reject_reason"


def place_reason() -> Column:
    """The rules that need no score."""
    return F.when(strip(blank(F.col("enterprise_number"))) == "", F.lit("enterprise_number")).when(
        ~strip(blank(F.col("postal_code"))).rlike(POSTCODE_SHAPE), F.lit("postal_code")
    )


def reject_reason() -> Column:
    """Why a lead is invalid, the first rule broken; null when it is valid."""
    score = F.col("score_total")
    return place_reason().when(score.isNull() | ~score.between(SCORE_FLOOR, SCORE_CEILING), F.lit("score_total"))


def valid_leads(df: DataFrame) -> DataFrame:
    return df.where(reject_reason().isNull())


def rejected_leads(df: DataFrame) -> DataFrame:
    """The invalid leads with the reason, for a quarantine table."""
    return df.withColumn(REASON, reject_reason()).where(F.col(REASON).isNotNull())


def require_valid(df: DataFrame) -> DataFrame:
    """All rows, with an error as soon as one of them is invalid."""
    broken = F.concat(F.lit("invalid "), reject_reason())
    return df.where(F.when(reject_reason().isNull(), F.lit(True)).otherwise(F.raise_error(broken).cast("boolean")))


def apply_policy(df: DataFrame, on_invalid: str) -> DataFrame:
    """``fail`` on invalid rows, or leave them out (``drop``, ``quarantine``).

    With ``quarantine`` they are not lost: a run returns them with their reasons
    and the sink writes them next to the leads.
    """
    return require_valid(df) if on_invalid == "fail" else valid_leads(df)
