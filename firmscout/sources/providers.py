"""Where a country's companies come from: load, normalise, enrich, as frame operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmscout.functions.text import blank, strip
from firmscout.operators.filters import first_rows, mentions
from firmscout.operators.joins import ORDER

# Raw field of a provider's record for each lead column, and the tag its rows carry.
PROVIDER_FIELDS = {
    "enterprise_number": "id",
    "name": "name",
    "address": "address",
    "postal_code": "postal_code",
    "city": "city",
}
CONTACT_FIELDS = ["phone", "email", "website"]
PROVIDER_TAG = "provider-template"


def normalize_records(raw: DataFrame) -> DataFrame:
    """Raw (id, name, address, postal_code, city) rows as lead columns, contacts empty."""
    texts = {
        column: strip(blank(F.col(field).cast("string"))) if field in raw.columns else F.lit("")
        for column, field in PROVIDER_FIELDS.items()
    }
    order = [ORDER] if ORDER in raw.columns else []
    return raw.select(
        *[c.alias(name) for name, c in texts.items()],
        *[F.lit("").alias(name) for name in CONTACT_FIELDS],
        F.lit(PROVIDER_TAG).alias("source_files_version"),
        *order,
    )


@dataclass(frozen=True)
class Provider:
    """A country's source. Each step but ``load`` takes and gives a frame."""

    country: str
    load: Callable[[SparkSession, str], DataFrame]
    normalize: Callable[[DataFrame], DataFrame] = normalize_records
    enrich: Callable[[DataFrame], DataFrame] = lambda df: df

    def records(self, spark: SparkSession, path: str) -> DataFrame:
        return self.load(spark, path).transform(self.normalize).transform(self.enrich)

    def search(self, spark: SparkSession, path: str, query: str, limit: int = 0) -> DataFrame:
        """The first records in file order that mention the query."""
        records = self.records(spark, path)
        if "sector_bucket" not in records.columns:
            records = records.withColumn("sector_bucket", F.lit(""))
        return first_rows(mentions(records, query), limit)


class Providers:
    """Providers by country code."""

    def __init__(self, *providers: Provider):
        self._by_country = {p.country.upper(): p for p in providers}

    def of(self, country: str) -> Provider:
        code = country.strip().upper()
        if code not in self._by_country:
            known = ", ".join(sorted(self._by_country)) or "none"
            raise ValueError(f"unsupported country '{country}', supported: {known}")
        return self._by_country[code]
