"""Joins that stay balanced when one key holds a large share of the rows.

Some keys of every big table may be very frequent and some are blank. Frequent
keys are left to adaptive execution, which cuts a large partition of the left
side into several tasks; the joins here are laid out so that it can. Nothing is
counted beforehand and no broadcast is asked for: Spark makes one where the
bytes it has seen allow it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER = "_ord"
_ROUTE, _PART = "_route", "_part"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage and scratch tables; in local mode the warehouse is one."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def stage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and write it to the reliable checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def is_blank(key: Column) -> Column:
    return F.coalesce(key, F.lit("")) == ""


def _routed(df: DataFrame, route: Column) -> DataFrame:
    """Two join keys, the second a function of the first.

    A lookup comes partitioned by its key; as that is not all join keys, Spark
    shuffles it once more, and only between two shuffles does it split a skewed
    partition. What is shuffled again has one row per key.
    """
    return df.withColumn(_ROUTE, route).withColumn(_PART, F.length(_ROUTE))


def _spread(left: DataFrame, key: str) -> DataFrame:
    """Rows without a key match nothing and go anywhere, by a hash of their position."""
    alone = F.concat(F.lit("~"), F.xxhash64(ORDER).cast("string"))
    return _routed(left, F.when(is_blank(F.col(key)), alone).otherwise(F.col(key)))


def attach(left: DataFrame, lookups: Sequence[DataFrame], key: str, how: str = "left") -> DataFrame:
    """Left outer join (or inner) of ``left`` with lookups that have one row per ``key``.

    The lookups are joined with each other first, where no key is frequent; the
    left side is shuffled once. Keys must not begin with a tilde.
    """
    merged = lookups[0]
    for lookup in lookups[1:]:
        merged = merged.join(lookup, key, "full")
    merged = _routed(merged, F.col(key)).drop(key)
    return _spread(left, key).join(merged, [_ROUTE, _PART], how).drop(_ROUTE, _PART)


def keep_matching(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is among ``keys``."""
    return _matching(df, keys, key, "left_semi")


def drop_matching(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is not among ``keys``, those without a key included."""
    return _matching(df, keys, key, "left_anti")


def _matching(df: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    known = keys.select(key).where(~is_blank(F.col(key))).distinct()
    known = _routed(known, F.col(key)).drop(key)
    return _spread(df, key).join(known, [_ROUTE, _PART], how).drop(_ROUTE, _PART)
