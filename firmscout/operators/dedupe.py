"""Duplicates by normalised name and address, within a run and against earlier output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmscout.functions.text import blank
from firmscout.operators.joins import ORDER, drop_matching

DEDUPE_KEY = "dedupe_key"


def comparable(value: Column) -> Column:
    """Lower-case letters and digits of any script, runs of anything else as one space."""
    return F.btrim(F.regexp_replace(F.lower(blank(value)), r"[^\p{L}\p{N}]+", " "))


def keyed(leads: DataFrame) -> DataFrame:
    """Add a hash of name and address; null when both are empty, as nothing identifies such a lead."""
    words = F.concat(comparable(F.col("name")), F.lit("|"), comparable(F.col("address")))
    key = F.when(F.col("_words") != "|", F.sha2("_words", 256))
    return leads.withColumn("_words", words).withColumn(DEDUPE_KEY, key).drop("_words")


def first_of_each(leads: DataFrame) -> DataFrame:
    """Per key the lead that comes first in file order; leads without a key all stay.

    The minimum combines map-side, so a key shared by a third of all leads sends
    one row per task. A lead without a key is a group of its own.
    """
    columns = [c for c in leads.columns if c != ORDER]
    alone = F.when(F.col(DEDUPE_KEY).isNull(), F.col(ORDER)).alias("alone")
    first = F.min(F.struct(F.col(ORDER), F.struct(*columns).alias("lead"))).alias("first")
    groups = keyed(leads).groupBy(DEDUPE_KEY, alone).agg(first)
    return groups.select("first.lead.*", DEDUPE_KEY, f"first.{ORDER}")


def not_seen_before(leads: DataFrame, earlier: DataFrame) -> DataFrame:
    """Leads whose key does not occur in earlier output (a frame with name and address)."""
    return drop_matching(keyed(leads), keyed(earlier), DEDUPE_KEY)
