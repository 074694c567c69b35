from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Rows of dicts as a text frame with ``_ord``, spread over partitions in scrambled order."""

    def make(rows, columns):
        data = [[*(row.get(c) for c in columns), i] for i, row in enumerate(rows)]
        schema = ", ".join(f"`{c}` string" for c in columns) + ", n long"
        df = spark.createDataFrame(data, schema).repartition(3, F.xxhash64("n"))
        order = F.struct(F.shiftright("n", 1).alias("chunk"), F.col("n"))
        return df.withColumn("_ord", order).drop("n")

    return make
