"""Key sets as Bloom filters, so that rows no one asks for are dropped before anything is shuffled.

A filter is one value of fixed size, whatever the number of keys, computed by a scalar subquery: building a
frame starts no job, Spark runs the subquery once before the scan that needs it, and the test runs inside that scan,
before the other columns of a row are computed. A filter lets some other rows through, more the fuller it is, and never
drops a row of the set; an exact join has to follow where that matters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmscout.operators.joins import stage

#: Places of a filter, a bit each, always a power of two. Of other keys the share that the filter is full passes: a fortieth at 100,000 keys, a
#: fifth at a million; set it to some twenty times the keys that are expected.
PLACES = 1 << 22
#: Bounds where the keys are counted.
LEAST_PLACES, MOST_PLACES = 1 << 16, 1 << 24
WORD = 64


def places_for(n_keys: int) -> int:
    """Places for a counted set: some twenty for each key, between the two bounds."""
    return min(MOST_PLACES, max(LEAST_PLACES, 1 << (20 * n_keys).bit_length()))


def key_bits(keys: DataFrame, key: str, places: int = PLACES, once: bool = False) -> Column:
    """The filter of ``keys[key]``, as a scalar subquery; null and repeated keys are fine.

    Bits are added up map-side, so a task sends one number per word of the filter at most, and end as one list of words.
    With ``once`` that is computed now and written, and what ``keys`` is made from is no part of plans with the filter.
    """
    known = keys.select(F.xxhash64(key).bitwiseAND(places - 1).alias("place")).where(F.col(key).isNotNull())
    ones = known.selectExpr("shiftright(place, 6) AS word", "shiftleft(1L, CAST(place & 63 AS INT)) AS ones")
    every = keys.sparkSession.range(places // WORD).selectExpr("id AS word", "0L AS ones")
    words = every.unionByName(ones).groupBy("word").agg(F.bit_or("ones").alias("ones"))
    listed = words.agg(F.sort_array(F.collect_list(F.struct("word", "ones"))).alias("all"))
    words = listed.select(F.col("all.ones").alias("words"))
    return (stage(words) if once else words).scalar()


def may_hold(filled: Column, key: Column, places: int = PLACES) -> Column:
    """Whether a key may be in the set of a filter."""
    hashed = F.xxhash64(key)
    word = F.get(filled, F.shiftright(hashed.bitwiseAND(places - 1), 6).cast("int"))
    return F.getbit(word, hashed.bitwiseAND(WORD - 1).cast("int")) == 1


def may_match(df: DataFrame, keys: DataFrame, key: str, on: str | None = None, places: int = PLACES) -> DataFrame:
    """Rows of ``df`` whose ``on`` (``key`` unless given) may be among ``keys[key]``; nothing is shuffled but the bits."""
    return df.where(may_hold(key_bits(keys, key, places), F.col(on or key), places))
