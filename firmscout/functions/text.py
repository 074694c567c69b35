"""Cleaning of identifiers, postcodes, status labels and free text.

Inside the engine text is clean: without surrounding white space, and null when
nothing is left; only identifiers are empty instead of null. ``cleaned`` makes a frame so, once, and the other functions rely
on it; stripping inside each of them would repeat the work for every mention of
a column. ``blank`` turns null into the empty string at the edge.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Every character that counts as white space around a value.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
# The first printing character of ASCII and the one behind the last.
PRINTING = ("!", "\x7f")
# Four digits that stand alone, with letters of any script as neighbours ruled out.
LONE_POSTCODE = r"(?<![\p{L}\p{N}_])([0-9]{4})(?![\p{L}\p{N}_])"
# Status codes, their labels, and the values that count as active.
STATUS_LABELS = {"AC": "ACTIVE", "IN": "INACTIVE"}
ACTIVE_VALUES = ["AC", "ACTIVE"]


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITESPACE))


def null_if_empty(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def cleaned(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The frame with the named text columns stripped, null where nothing is left.

    Two projections, so that each column is stripped once. A text that begins and ends in a printing ASCII character is
    taken as it is: looking for each end among all white space costs more than anything else in mapping a row.
    """
    texts, every, kinds = set(columns), df.columns, dict(df.dtypes)
    first, behind = PRINTING

    def stripped(c: str) -> str:
        whole = f"btrim(`{c}`, '{WHITESPACE}')"
        if kinds[c] != "string":
            return whole
        # Texts compare by their bytes, so both tests are about the first byte alone.
        ends = [f"{end} >= '{first}' AND {end} < '{behind}'" for end in (f"`{c}`", f"right(`{c}`, 1)")]
        return f"CASE WHEN {' AND '.join(ends)} THEN `{c}` ELSE {whole} END"

    trimmed = [f"{stripped(c)} AS `{c}`" if c in texts else f"`{c}`" for c in every]
    emptied = [f"nullif(`{c}`, '') AS `{c}`" if c in texts else f"`{c}`" for c in every]
    return df.selectExpr(*trimmed).selectExpr(*emptied)


def blank(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def is_missing(value: Column) -> Column:
    return F.coalesce(strip(value) == "", F.lit(True))


def digits(text: Column) -> Column:
    """Identifier reduced to its digits, empty when it has none.

    Never null: Spark would put a null test of every join key below the columns
    it is made from, and so compute it over again.
    """
    return F.coalesce(F.regexp_replace(text, "[^0-9]+", ""), F.lit(""))


def postal_code(text: Column) -> Column:
    """The first stand-alone run of four digits, else the text."""
    return F.coalesce(null_if_empty(F.regexp_extract(text, LONE_POSTCODE, 1)), text)


def status_label(text: Column) -> Column:
    known = [F.when(F.upper(text) == code, F.lit(name)) for code, name in STATUS_LABELS.items()]
    return F.coalesce(*known, text)


def is_active(status: Column) -> Column:
    return F.coalesce(F.upper(status).isin(ACTIVE_VALUES), F.lit(False))


def yes_no(flag: Column) -> Column:
    return F.when(flag, F.lit("yes")).otherwise(F.lit("no"))
