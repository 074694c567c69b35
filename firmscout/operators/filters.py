"""Row filters of a lead run, each on plain columns so that Catalyst can move them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmscout.functions.dates import first_young_day, parse_date
from firmscout.functions.text import blank, is_active
from firmscout.operators.joins import ORDER, keep_matching


def active(df: DataFrame) -> DataFrame:
    return df.where(is_active(F.col("status")))


def dated(df: DataFrame) -> DataFrame:
    return df.where(F.col("start_date").isNotNull())


def region_test(codes: Sequence[str]) -> Column:
    """Whether the postcode is in the region; no codes means every region."""
    return F.coalesce(F.col("postal_code").isin(list(codes)), F.lit(False)) if codes else F.lit(True)


def in_region(df: DataFrame, codes: Sequence[str] | DataFrame) -> DataFrame:
    """Rows whose ``postal_code`` is listed, in a sequence or in a frame of that column."""
    if isinstance(codes, DataFrame):
        return keep_matching(df, codes, "postal_code")
    return df.where(region_test(codes))


def young(df: DataFrame, as_of: date, max_months: int) -> DataFrame:
    """Known start, at most ``max_months`` calendar months before ``as_of``; later starts pass too."""
    return df.where(parse_date(F.col("start_date")) >= F.lit(first_young_day(as_of, max_months)))


def in_city(df: DataFrame, text: str) -> DataFrame:
    text = text.strip().lower()
    return df.where(F.contains(F.lower(blank(F.col("city"))), F.lit(text))) if text else df


def mentions(df: DataFrame, text: str) -> DataFrame:
    """Rows whose name and sector, joined by a space, contain the text."""
    text = text.strip().lower()
    haystack = F.lower(F.concat(blank(F.col("name")), F.lit(" "), blank(F.col("sector_bucket"))))
    return df.where(F.contains(haystack, F.lit(text))) if text else df


def scored_at_least(df: DataFrame, floor: int) -> DataFrame:
    return df.where(F.col("score_total") >= floor)


def usable(df: DataFrame) -> DataFrame:
    """Leads with a name, a postcode and city, and at least one way to reach them."""
    def given(column: str) -> Column:
        return blank(F.col(column)) != ""

    located = given("postal_code") & given("city")
    return df.where(given("name") & located & (given("phone") | given("email") | given("website")))


#: Up to so many rows a limit is one ordered limit, whose rows meet in a task.
ORDERED_LIMIT = 10_000


def first_rows(df: DataFrame, count: int, ordered: int = ORDERED_LIMIT) -> DataFrame:
    """The first ``count`` rows in file order, all when it is 0.

    Beyond ``ordered`` rows no task gets them all: rows are counted per ``_ord.chunk``, a running sum over the chunks, of
    which there is one per million rows of a file, finds the chunk the limit falls in, and rows are numbered within their
    chunk. ``df`` is computed twice then.
    """
    if not count:
        return df
    if count <= ordered:
        return df.orderBy(ORDER).limit(count)
    chunk = F.col(f"{ORDER}.chunk")
    sizes = df.groupBy(chunk.alias("_chunk")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_chunk")) - F.col("_n")
    needed = sizes.withColumn("_before", before).where(F.col("_before") < count).select("_chunk", "_before")
    place = F.row_number().over(Window.partitionBy("_chunk").orderBy(ORDER)) + F.col("_before")
    kept = df.withColumn("_chunk", chunk).join(needed, "_chunk")
    return kept.withColumn("_place", place).where(F.col("_place") <= count).select(*df.columns)


def by_score(df: DataFrame) -> DataFrame:
    """Highest score first, file order among equals."""
    return df.orderBy(F.desc("score_total"), ORDER)


def top_scored(df: DataFrame, count: int) -> DataFrame:
    """The ``count`` best leads, as opposed to the best of the first ``count``."""
    return by_score(df).limit(count)
