"""What several operators of this package share."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmscout.operators.joins import checkpoint_dir

# A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and write it to the shared checkpoint folder; lost executors do not lose it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def picked(df: DataFrame, *names: str) -> DataFrame:
    """The columns with exactly these names, also where others differ from them in case only."""
    place = [df.columns.index(n) for n in names]
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))]).select(*[F.col(f"_{i}").alias(n) for i, n in zip(place, names)])


def numbered(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with all columns but these named by their place, so that none clashes with a working column.

    ``toDF(*df.columns)`` gives the names back.
    """
    place = {df.columns.index(n): n for n in names}
    return df.toDF(*[place.get(i, f"_{i}") for i in range(len(df.columns))])


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts, one aggregate over one column."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def parts_for(n_bytes: int, each: int, least: int = 1) -> int:
    """How many buckets of about ``each`` bytes hold ``n_bytes``: grows with the data, so buckets do not."""
    return max(least, math.ceil(n_bytes / each))


def ranked(df: DataFrame, *order: str, rank: str = "_rank") -> DataFrame:
    """``df`` with its 0-based place in the order of ``order``, without sorting all rows in one task.

    Rows are range-partitioned and staged; only the row counts of the partitions meet in one task.
    """
    parts = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    cut = staged(df.repartitionByRange(int(parts), *order).withColumn("_part", F.spark_partition_id()))
    before = "sum(_n) OVER (ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - _n AS _before"
    counts = cut.groupBy("_part").agg(F.count("*").alias("_n")).selectExpr("_part", before)
    place = f"row_number() OVER (PARTITION BY _part ORDER BY {', '.join(order)}) - 1 + _before"
    out = cut.join(F.broadcast(counts), "_part").withColumn(rank, F.expr(place).cast("long"))
    return out.drop("_part", "_before")
