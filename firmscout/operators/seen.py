"""The duplicate keys of all earlier runs, kept as a table that grows by each run.

Names and addresses of the past are never read or hashed again: a run writes its keys, partitioned by how they begin, and
the next one reads the partitions its own keys begin with.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from firmscout.operators.dedupe import DEDUPE_KEY, keyed
from firmscout.operators.joins import drop_matching

PREFIX, RUN = "key_prefix", "run"


@dataclass(frozen=True)
class SeenKeys:
    """A folder of keys that all executors share; ``digits`` hexadecimal digits of a key name its partition.

    All runs over a folder need the same ``digits``.
    """

    spark: SparkSession
    path: str
    digits: int = 2

    def keys(self) -> DataFrame:
        """``dedupe_key``, ``run`` and ``key_prefix`` of everything seen; empty before the first run."""
        fields = [StructField(c, StringType()) for c in (DEDUPE_KEY, RUN, PREFIX)]
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], StructType(fields))
        return self.spark.read.schema(StructType(fields)).parquet(self.path)

    def unseen(self, leads: DataFrame) -> DataFrame:
        """Leads, with their key, whose key no run has written yet; those without a key all stay."""
        now = keyed(leads)
        prefixes = now.select(self._prefix().alias(PREFIX)).where(F.col(PREFIX).isNotNull()).distinct()
        return drop_matching(now, self.keys().join(prefixes, PREFIX, "left_semi"), DEDUPE_KEY)

    def add(self, leads: DataFrame, run: str) -> None:
        """Write the keys of a run's leads; a run that is written again replaces nothing and changes nothing."""
        rows = (leads if DEDUPE_KEY in leads.columns else keyed(leads)).where(F.col(DEDUPE_KEY).isNotNull())
        rows = rows.select(DEDUPE_KEY).distinct().select(DEDUPE_KEY, F.lit(run).alias(RUN), self._prefix().alias(PREFIX))
        rows.repartition(PREFIX).write.mode("append").partitionBy(PREFIX).parquet(self.path)

    def _prefix(self) -> Column:
        return F.substring(DEDUPE_KEY, 1, self.digits)
