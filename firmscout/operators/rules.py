"""Sectors by a table of rules of any size, the longest prefix of a code deciding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscout.functions.sectors import activity_code
from firmscout.operators.joins import attach

OTHER = "other"
_CODE = "_code"


def code_sectors(codes: DataFrame, rules: DataFrame, code: str = "nace_code") -> DataFrame:
    """The sector of every distinct code: ``_code``, ``sector``; codes that no rule fits are left out.

    ``rules`` has ``prefix`` and ``sector``. Codes and prefixes are compared in the form of ``activity_code``. Of rules
    with the same prefix the sector first in text order counts; a rule without prefix or sector does not count. Each
    code, however frequent, is looked up once, under all its prefixes, so that rules are found by an equi-join.
    """
    known = rules.select(activity_code(F.col("prefix")).alias("prefix"), "sector")
    known = known.where((F.col("prefix") != "") & F.col("sector").isNotNull()).groupBy("prefix").agg(F.min("sector").alias("sector"))
    distinct = codes.select(activity_code(F.col(code)).alias(_CODE)).where(F.col(_CODE) != "").distinct()
    lengths = F.explode(F.sequence(F.lit(1), F.length(_CODE))).alias("_size")
    parts = distinct.select(_CODE, lengths).withColumn("prefix", F.substr(_CODE, F.lit(1), F.col("_size")))
    fits = parts.join(known, "prefix")
    return fits.groupBy(_CODE).agg(F.max_by("sector", "_size").alias("sector"))


def with_sector(rows: DataFrame, rules: DataFrame, code: str = "nace_code", sector: str = "sector_bucket") -> DataFrame:
    """Rows (with ``_ord``) and the sector their code has by ``rules``; ``other`` without a code or a rule for it."""
    keyed = rows.withColumn(_CODE, activity_code(F.col(code)))
    joined = attach(keyed, [code_sectors(rows, rules, code).withColumnRenamed("sector", "_sector")], _CODE)
    return joined.withColumn(sector, F.coalesce("_sector", F.lit(OTHER))).drop(_CODE, "_sector")
