"""Reports over tables, stages and leads. Ties keep the order in which values were first seen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscout.functions.dates import parse_date
from firmscout.functions.text import blank
from firmscout.operators.filters import active
from firmscout.operators.joins import ORDER
from firmscout.operators.lookups import best_contacts, is_activity, is_address, is_denomination

# Lengths of the reports.
TOP = 10
SAMPLE = 3
ESTABLISHMENT_KEYS = ["address", "city", "enterprise_number", "establishment_number", "postal_code"]


def sector_counts(leads: DataFrame, top: int = TOP) -> DataFrame:
    """The most common sectors; a tie goes to the one seen first in score order."""
    seen = F.min(F.struct((-F.col("score_total")).alias("s"), F.col(ORDER)))
    counted = leads.groupBy("sector_bucket").agg(F.count("*").alias("leads"), seen.alias("_seen"))
    return counted.orderBy(F.desc("leads"), "_seen").limit(top).select("sector_bucket", "leads")


def postcode_profile(located: DataFrame) -> DataFrame:
    """How many active enterprises have a postcode."""
    empty = F.count_if(F.col("postal_code").isNull())
    return active(located).agg(
        F.count("*").alias("total"), empty.alias("empty"), (F.count("*") - empty).alias("non_empty")
    )


def postcode_counts(located: DataFrame, top: int = TOP) -> DataFrame:
    known = active(located).where(F.col("postal_code").isNotNull())
    counted = known.groupBy("postal_code").agg(F.count("*").alias("enterprises"), F.min(ORDER).alias("_seen"))
    return counted.orderBy(F.desc("enterprises"), "_seen").limit(top).select("postal_code", "enterprises")


def postcode_sample(located: DataFrame, count: int = SAMPLE) -> DataFrame:
    """Where the postcode of the first active enterprises came from."""
    keys = F.when(F.col("has_establishment"), F.lit(",".join(ESTABLISHMENT_KEYS))).otherwise(F.lit(""))
    return active(located).orderBy(ORDER).limit(count).select(
        blank(F.col("enterprise_number")).alias("enterprise_number"),
        blank(F.col("establishment_number")).alias("establishment_number"),
        blank(F.col("postal_code")).alias("computed_postcode"),
        blank(F.col("est_postal_code")).alias("est_postal_code"),
        blank(F.col("own_postal_code")).alias("enterprise_postal_code"),
        keys.alias("est_keys"),
    )


def result_profile(leads: DataFrame) -> DataFrame:
    """Rows, distinct enterprises and the range of start dates.

    Counted per enterprise first, so the distinct count needs no set of ids.
    """
    dated = leads.select("enterprise_number", parse_date(F.col("start_date")).alias("start"))
    per_id = dated.groupBy("enterprise_number").agg(
        F.count("*").alias("n"), F.min("start").alias("first"), F.max("start").alias("last")
    )
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.count_if(F.col("enterprise_number") != "").alias("unique_enterprises"),
        F.min("first").alias("min_start_date"),
        F.max("last").alias("max_start_date"),
    )


def result_ids(leads: DataFrame, count: int = TOP) -> DataFrame:
    """The first enterprise numbers in sorted order."""
    numbers = leads.where(F.col("enterprise_number") != "").select("enterprise_number").distinct()
    return numbers.orderBy("enterprise_number").limit(count)


def preview(leads: DataFrame, count: int = SAMPLE) -> DataFrame:
    columns = ["enterprise_number", "name", "postal_code", "city", "phone", "email", "website"]
    return leads.orderBy(ORDER).limit(count).select(*columns)


def join_coverage(flagged: DataFrame) -> DataFrame:
    """Enterprises of any status with an establishment and with a contact."""
    totals = flagged.agg(
        F.count("*").alias("enterprises"),
        F.count_if("has_establishment").alias("with_establishment"),
        F.count_if("has_contact").alias("with_contact"),
    )

    def percent(column: str):
        return F.try_divide(F.lit(100.0) * F.col(column), F.col("enterprises"))

    return totals.withColumns(
        {"establishment_percent": percent("with_establishment"), "contact_percent": percent("with_contact")}
    )


def stage_funnel(flagged: DataFrame) -> DataFrame:
    """Enterprises left after each stage, from one pass over the flags."""
    on = F.col("is_active")
    return flagged.agg(
        F.count("*").alias("loaded"),
        F.count_if(on).alias("active"),
        F.count_if(on & F.col("has_establishment")).alias("with_establishment"),
        F.count_if(on & F.col("has_contact")).alias("with_contact"),
        F.count_if(on & F.col("is_dated") & F.col("is_in_region")).alias("after_postcode"),
    )


def run_report(flagged: DataFrame) -> DataFrame:
    """Postcode profile, coverage and funnel as rows ``report``, ``measure``, ``value``, from one pass over the flags.

    Equal to ``postcode_profile``, ``join_coverage`` and ``stage_funnel`` over the same enterprises, each of which reads
    all tables for itself; here every table is read once for all of them.
    """
    on = F.col("is_active")
    placed = on & F.col("postal_code").isNotNull()
    count = {
        ("postcode_profile", "total"): F.count_if(on),
        ("postcode_profile", "empty"): F.count_if(on & F.col("postal_code").isNull()),
        ("postcode_profile", "non_empty"): F.count_if(placed),
        ("join_coverage", "enterprises"): F.count("*"),
        ("join_coverage", "with_establishment"): F.count_if("has_establishment"),
        ("join_coverage", "with_contact"): F.count_if("has_contact"),
        ("stage_funnel", "loaded"): F.count("*"),
        ("stage_funnel", "active"): F.count_if(on),
        ("stage_funnel", "with_establishment"): F.count_if(on & F.col("has_establishment")),
        ("stage_funnel", "with_contact"): F.count_if(on & F.col("has_contact")),
        ("stage_funnel", "after_postcode"): F.count_if(on & F.col("is_dated") & F.col("is_in_region")),
    }
    rows = [
        F.struct(F.lit(report).alias("report"), F.lit(measure).alias("measure"), value.cast("bigint").alias("value"))
        for (report, measure), value in count.items()
    ]
    return flagged.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, and the rows that carry a key and a value where the table demands them.

    For contacts also the enterprises that have one, their own or that of an establishment.
    """
    usable = {"address": is_address(), "activity": is_activity(), "denomination": is_denomination()}
    none = F.lit(None).cast("bigint")
    parts = [
        df.agg(F.count("*").alias("loaded"), F.count_if(usable.get(name, F.lit(True))).alias("usable")).select(
            F.lit(name).alias("relation"), "loaded", "usable", none.alias("enterprises")
        )
        for name, df in tables.items()
    ]
    if "contact" in tables and "establishment" in tables:
        reached = best_contacts(tables["contact"], tables["establishment"]).agg(F.count("*").alias("enterprises"))
        parts.append(reached.select(F.lit("contact").alias("relation"), none.alias("loaded"), none.alias("usable"), "enterprises"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("relation").agg(*[F.max(c).alias(c) for c in ("loaded", "usable", "enterprises")])
