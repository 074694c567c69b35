"""One registered query per operator, all over the whole bound tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firmscout.functions import sectors, text
from firmscout.functions.dates import parse_date
from firmscout.operators import dedupe, filters, gaps, lookups, mapping, profile, quality, rules
from firmscout.operators.joins import ORDER, attach, checkpoint_dir, stage
from firmscout.operators.mapping import clean_text
from firmscout.operators.seen import SeenKeys
from firmscout.plans import leads as plan
from firmscout.plans import region, snapshots
from firmscout.plans.leads import KEY, LEAD_COLUMNS
from firmscout.sources.delimited import read_delimited, read_strict
from firmscout.sources.files import TABLE_FILES
from firmscout.sources.providers import Provider, Providers
from firmscout.sources.sink import dry_run, export_leads, export_run, write_delimited
from firmscout.sources.snapshot import load_enterprises, load_snapshot, raw_table
from suite import bindings
from suite.bindings import AS_OF, EARLIER_REGION, REGION, params, raw, registry

Query = Callable[[SparkSession, str], DataFrame]

FLAGSHIP_MONTHS = 36
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def plain(df: DataFrame) -> DataFrame:
    """Without the row order, missing text as empty text."""
    texts = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    return df.select(
        *[text.blank(F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns if c != ORDER]
    )


# Whole runs


@query
def lead_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = registry(spark, sf_dir, "enterprise", "establishment", "address")
    return plan.build_leads(tables, params(months=FLAGSHIP_MONTHS))


@query
def leads_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.build_leads(registry(spark, sf_dir), params(months=FLAGSHIP_MONTHS))


@query
def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.build_leads(plan.cut_down(registry(spark, sf_dir), params()), params())


@query
def leads_every_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.build_leads(registry(spark, sf_dir), params(postcodes=()))


@query
def leads_lite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.build_leads(registry(spark, sf_dir), params(lite=True))


@query
def leads_region_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region.region_leads(registry(spark, sf_dir), params())


@query
def leads_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.build_leads(registry(spark, sf_dir), params(city="nation_1", postcodes=()))


@query
def leads_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.build_leads(registry(spark, sf_dir), params(query="BEAUTY", postcodes=(), months=FLAGSHIP_MONTHS))


@query
def leads_min_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.build_leads(registry(spark, sf_dir), params(min_score=40, postcodes=()))


@query
def leads_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.build_leads(registry(spark, sf_dir), params(limit=25, postcodes=()))


@query
def leads_top_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = plan.lead_rows(registry(spark, sf_dir), params(postcodes=()))
    return filters.top_scored(rows, 25).select(*LEAD_COLUMNS)


@query
def leads_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.preview(plan.lead_rows(registry(spark, sf_dir), params()))


# Mapping of raw tables


@query
def map_enterprise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(registry(spark, sf_dir, "enterprise", "establishment").enterprise)


@query
def map_establishment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(registry(spark, sf_dir, "enterprise", "establishment").establishment)


@query
def build_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_table(spark, sf_dir, "address"))


@query
def map_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_table(spark, sf_dir, "activity"))


@query
def map_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_table(spark, sf_dir, "contact"))


@query
def map_denomination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_table(spark, sf_dir, "denomination"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return getattr(registry(spark, sf_dir, *dict.fromkeys(["enterprise", "establishment", name])), name)


def _raw_with(spark: SparkSession, sf_dir: str, name: str, kept: dict[str, str], **columns: Column) -> DataFrame:
    """Raw columns under new names beside functions of their clean text."""
    rows = raw(spark, sf_dir, name)
    rows = rows.select(*[F.col(c).alias(f"_{n}") for n, c in kept.items()], *rows.columns)
    found = clean_text(rows).select(*[f"_{n}" for n in kept], *[c.alias(n) for n, c in columns.items()])
    return found.withColumnsRenamed({f"_{n}": n for n in kept})


# Scalar functions


@query
def normalize_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_with(spark, sf_dir, "contact", {"raw_id": "entitynumber"}, id=text.digits(F.col("entitynumber")))


@query
def normalize_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, status = {"enterprise": "enterprisenumber", "raw_status": "status"}, F.col("status")
    return _raw_with(
        spark, sf_dir, "enterprise", kept, status=text.status_label(status), is_active=text.is_active(status)
    )


@query
def active_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(filters.dated(filters.active(_table(spark, sf_dir, "enterprise"))))


@query
def young_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(filters.young(_table(spark, sf_dir, "enterprise"), AS_OF, 18))


@query
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = {"enterprise": "enterprisenumber", "raw_date": "startdate"}
    return _raw_with(spark, sf_dir, "enterprise", kept, start_date=parse_date(F.col("startdate")))


@query
def age_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = plan.with_age(_table(spark, sf_dir, "enterprise"), params())
    return dated.select(KEY, "age_months")


@query
def normalize_postcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = {"enterprise": "enterprisenumber", "raw_code": "postcode"}
    code = text.blank(text.postal_code(F.col("postcode")))
    return _raw_with(spark, sf_dir, "enterprise", kept, postal_code=code)


@query
def sector_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, code = {"enterprise": "enterprisenumber"}, F.col("nace_code")
    return _raw_with(
        spark,
        sf_dir,
        "activity",
        kept,
        code=text.blank(sectors.activity_code(code)),
        sector_bucket=sectors.sector_of(code),
    )


@query
def ensure_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outside sectors in odd spellings; those of rows without a code are no sector at all."""
    code = F.col("nace_code")
    tail = F.when(code == "", F.lit("?")).otherwise(" ")
    outside = F.concat(F.lit(" "), F.upper(sectors.sector_of(code)), tail)
    rows = raw(spark, sf_dir, "activity").select(F.col("enterprisenumber").alias("enterprise"), outside.alias("outside"))
    return rows.withColumn("sector_bucket", sectors.allowed_sector(F.col("outside")))


@query
def score_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lead score of every enterprise, whatever its status, age or region."""
    tables = registry(spark, sf_dir)
    every = plan.with_age(plan.located_enterprises(tables), params())
    details = plan.with_details(every, tables)
    columns = ["enterprise_number", "sector_bucket", "has_website", "score_total", "score_reasons"]
    return plan.scored(details, params(), tables.snapshot).select(*columns)


@query
def score_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = registry(spark, sf_dir)
    first = lookups.first_activity(tables.activity).withColumnRenamed("first_code", "nace")
    contacts = lookups.best_contacts(tables.contact, tables.establishment).drop("website")
    companies = attach(tables.enterprise.select(KEY, "start_date", ORDER), [first, contacts], KEY)
    scored = gaps.by_gap_score(gaps.score_gaps(companies, datetime.combine(AS_OF, time()), 18))
    return plain(scored.select(KEY, "sector", "score_total", "score_reasons", ORDER))


# Keyed lookups and joins


@query
def address_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(lookups.latest_address(_table(spark, sf_dir, "address")))


@query
def establishment_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = registry(spark, sf_dir, "enterprise", "establishment", "address")
    return plain(lookups.filled_establishments(tables.establishment, tables.address))


@query
def primary_establishment(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = registry(spark, sf_dir, "enterprise", "establishment", "address")
    filled = lookups.filled_establishments(tables.establishment, tables.address)
    return plain(lookups.primary_establishment(filled))


@query
def enterprise_located(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(plan.located_enterprises(registry(spark, sf_dir, "enterprise", "establishment", "address")))


@query
def establishment_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.establishment_owner(_table(spark, sf_dir, "establishment"))


@query
def contacts_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = registry(spark, sf_dir, "enterprise", "establishment", "contact")
    return plain(lookups.resolve_contacts(tables.contact, tables.establishment))


@query
def contacts_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = registry(spark, sf_dir, "enterprise", "establishment", "contact")
    return plain(lookups.best_contacts(tables.contact, tables.establishment))


@query
def denomination_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.best_denomination(_table(spark, sf_dir, "denomination"))


@query
def activity_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.activity_codes(_table(spark, sf_dir, "activity"))


@query
def activity_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.first_activity(_table(spark, sf_dir, "activity"))


@query
def region_prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per key that each relation keeps in the region."""
    cut = region.region_prefilter(registry(spark, sf_dir), REGION).registry
    keys = {"address": "establishment_number", "establishment": "establishment_number", "enterprise": KEY}
    kept = [(name, getattr(cut, name).select(F.col(key).alias("number"))) for name, key in keys.items()]
    kept.append(("activity", cut.activity.select(F.col(KEY).alias("number"))))
    parts = [
        rows.groupBy("number").agg(F.count("*").alias("kept")).select(F.lit(name).alias("relation"), "number", "kept")
        for name, rows in kept
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def region_filter_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enterprises whose own postcode is the postcode of some establishment."""
    tables = registry(spark, sf_dir, "enterprise", "establishment")
    codes = tables.establishment.select(text.postal_code(F.col("postal_code")).alias("postal_code"))
    own = tables.enterprise.select(KEY, text.postal_code(F.col("postal_code")).alias("postal_code"), ORDER)
    return plain(filters.in_region(own, codes))


# Reports


@query
def sector_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.sector_counts(plan.lead_rows(registry(spark, sf_dir), params(postcodes=())))


def _located(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.located_enterprises(registry(spark, sf_dir, "enterprise", "establishment", "address"))


@query
def postcode_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.postcode_profile(_located(spark, sf_dir))


@query
def postcode_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.postcode_counts(_located(spark, sf_dir))


@query
def postcode_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.postcode_sample(_located(spark, sf_dir))


@query
def result_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.result_profile(plan.lead_rows(registry(spark, sf_dir), params()))


@query
def result_sample_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.result_ids(plan.lead_rows(registry(spark, sf_dir), params()))


@query
def join_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.join_coverage(plan.flagged_enterprises(registry(spark, sf_dir), params()))


@query
def stage_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.stage_funnel(plan.flagged_enterprises(registry(spark, sf_dir), params()))


@query
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postcode profile, coverage and funnel of one run, from one reading of its tables."""
    return profile.run_report(plan.flagged_enterprises(registry(spark, sf_dir), params()))


@query
def region_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The funnel of the region-first run, with the sizes of its key sets."""
    cut = region.region_prefilter(registry(spark, sf_dir), REGION)
    establishments, enterprises = cut.sizes()
    return profile.stage_funnel(plan.flagged_enterprises(cut.registry, params())).withColumns(
        {
            "establishments_in_area": F.lit(establishments).cast("bigint"),
            "enterprises_in_area": F.lit(enterprises).cast("bigint"),
        }
    )


@query
def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = registry(spark, sf_dir)
    return profile.load_counts({name: getattr(tables, name) for name in bindings.RAW_TABLES})


# Quality and duplicates


def _unchecked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads of every region before the validity check, some without their postcode."""
    rows = plan.all_leads(registry(spark, sf_dir), params(postcodes=()))
    lost = F.substring(KEY, 2, 9).cast("int") % 13 == 0
    return rows.withColumn("postal_code", F.when(lost, F.lit("")).otherwise(F.col("postal_code")))


@query
def valid_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.valid_leads(_unchecked(spark, sf_dir)).select(*LEAD_COLUMNS)


@query
def rejected_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rejected_leads(_unchecked(spark, sf_dir)).select(*LEAD_COLUMNS, quality.REASON)


@query
def usable_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.usable(plan.lead_rows(registry(spark, sf_dir), params(postcodes=()))).select(*LEAD_COLUMNS)


@query
def dedupe_in_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and addresses of all establishments' owners repeat, so leads here are (denomination, street) rows."""
    names = _table(spark, sf_dir, "denomination").withColumnRenamed("denomination", "name")
    rows = names.select(KEY, "name", F.col("language").alias("address"), ORDER)
    return plain(dedupe.first_of_each(rows))


@query
def dedupe_cross_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads that a run over a part of the region did not yield."""
    tables = registry(spark, sf_dir)
    now = plan.lead_rows(tables, params(months=FLAGSHIP_MONTHS))
    earlier = plan.lead_rows(tables, params(months=FLAGSHIP_MONTHS, postcodes=EARLIER_REGION))
    return dedupe.not_seen_before(now, earlier).select(*LEAD_COLUMNS, dedupe.DEDUPE_KEY)


# Sources and sinks


def _scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of the session."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}.csv"


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts, with their quotes, delimiters and line breaks, through a delimited table."""
    path = _scratch(spark, "documents")
    documents = bindings.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string"), "source", "text")
    write_delimited(documents, path, delimiter=";")
    return plain(read_delimited(spark, path))


@query
def csv_strict_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as unquoted lines; those of errors have a field too many and are dropped."""
    path = _scratch(spark, "events")
    extra = F.when(F.col("event_type") == "error", F.lit(";extra")).otherwise("")
    line = F.concat(F.col("event_id"), F.lit(";"), F.col("event_type"), extra)
    events = bindings.table(spark, sf_dir, "events")
    events.select(line.alias("event_id;event_type")).write.options(
        header=True, quote="", sep="\u0001", ignoreTrailingWhiteSpace=False
    ).csv(path)
    good, _ = read_strict(spark, path, max_bad_rows=events.count())
    return plain(good)


@query
def csv_latin1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "customers")
    customers = bindings.table(spark, sf_dir, "customer")
    named = customers.select(
        F.col("c_custkey").cast("string").alias("id"), F.concat(F.lit("Café "), "c_name").alias("name")
    )
    write_delimited(named, path, delimiter=",", encoding="ISO-8859-1")
    return plain(read_delimited(spark, path))


@query
def synonym_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enterprise table under Dutch and French headers, back to the standard names."""
    path = _scratch(spark, "ondernemingen")
    rows = raw(spark, sf_dir, "enterprise")
    write_delimited(
        rows.select(
            F.col("enterprisenumber").alias("Ondernemingsnummer"),
            F.col("status").alias("Statuut"),
            F.col("startdate").alias("Datum start"),
            F.col("postcode").alias("Code postal"),
            F.col("city").alias("Gemeente"),
        ),
        path,
        delimiter=";",
    )
    return plain(load_enterprises(spark, path))


@query
def provider_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    provider = Provider("XX", load=_customers)
    return plain(provider.records(spark, sf_dir))


@query
def provider_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that mention a number, all of them."""
    provider = Provider("XX", load=_customers)
    return plain(provider.search(spark, sf_dir, "customer#0000000"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = bindings.table(spark, sf_dir, "customer")
    return customers.select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit("  "), "c_name").alias("name"),
        F.col("c_mktsegment").alias("address"),
        F.lit(None).cast("string").alias("postal_code"),
        F.struct(F.shiftright("c_custkey", 16).alias("chunk"), "c_custkey").alias(ORDER),
    )


# From files to files


def _snapshot(spark: SparkSession, sf_dir: str, *tables: str) -> str:
    """The bound tables as delimited files, in file order, in the dated folder of a new snapshot folder."""
    parent = _scratch(spark, "snapshot").removesuffix(".csv")
    for name in tables:
        rows = raw(spark, sf_dir, name, in_order=True).drop(ORDER)
        write_delimited(rows, f"{parent}/{bindings.SNAPSHOT}/{TABLE_FILES[name][0]}", delimiter=";")
    return parent


def _read_leads(spark: SparkSession, path: str) -> DataFrame:
    back = plain(read_delimited(spark, path, may_be_empty=True))
    return back.withColumn("score_total", F.col("score_total").cast("int"))


@query
def leads_from_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole program: a snapshot folder read, converted once, run, and exported."""
    parent = _snapshot(spark, sf_dir, *TABLE_FILES)
    tables = load_snapshot(spark, parent, work_dir=f"{parent}-work")
    out = _scratch(spark, "leads")
    export_leads(plan.lead_rows(plan.cut_down(tables, params()), params()), out)
    return _read_leads(spark, out)


@query
def leads_from_snapshot_no_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a contact table, and with an empty one of denominations."""
    parent = _snapshot(spark, sf_dir, "enterprise", "establishment", "address", "activity")
    empty = f"{parent}/{bindings.SNAPSHOT}/{TABLE_FILES['denomination'][0]}"
    spark.createDataFrame([], "value string").write.text(empty)
    return plan.build_leads(plan.cut_down(load_snapshot(spark, parent), params()), params())


@query
def export_with_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and rejected rows of one run, written and read back."""
    rows = stage(_unchecked(spark, sf_dir))
    path = _scratch(spark, "leads")
    run = plan.LeadRun(quality.valid_leads(rows), quality.rejected_leads(rows), staged=True)
    export_run(run, path, f"{path}-rejected")
    good = _read_leads(spark, path).withColumn(quality.REASON, F.lit(""))
    return good.unionByName(_read_leads(spark, f"{path}-rejected"))


@query
def dry_run_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many leads a run over all regions would write."""
    count = dry_run(plan.lead_rows(registry(spark, sf_dir), params(postcodes=())))
    return spark.range(1).select(F.lit(count).cast("bigint").alias("leads"))


@query
def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one table whose columns come in different order, one without a column."""
    path = _scratch(spark, "customers")
    customers = bindings.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name", "c_mktsegment")
    columns = [["id", "c_name", "c_mktsegment"], ["c_mktsegment", "id", "c_name"], ["c_name", "id"]]
    for i, names in enumerate(columns):
        part = customers.where(F.col("id") % 3 == i).select(*names)
        part.write.mode("append").options(header=True, sep=";").csv(path)
    return plain(read_delimited(spark, path))


@query
def csv_stray_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes inside unquoted fields, which open nothing."""
    path = _scratch(spark, "parts")
    line = F.concat("p_partkey", F.lit(';5" '), "p_name", F.lit(";x"))
    lines = bindings.table(spark, sf_dir, "part").select(line.alias("id;name;mark"))
    lines.write.options(header=True, quote="", sep="\u0001", ignoreTrailingWhiteSpace=False).csv(path)
    return plain(read_delimited(spark, path))


@query
def columns_by_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers that collide (the last one counts), and columns known by a word in their name only."""
    path = _scratch(spark, "establishments")
    rows = raw(spark, sf_dir, "establishment").select(
        F.col("enterprisenumber").alias("EnterpriseNumber"),
        F.col("establishmentnumber").alias("EstablishmentNumber"),
        F.lit("0000").alias("Zipcode"),
        F.col("postcode").alias("Postal Code"),
        F.col("street").alias("Old street, as written"),
    )
    write_delimited(rows, path, delimiter=";")
    return plain(mapping.map_establishment(raw_table(spark, path)))


@query
def table_by_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Dutch enterprise table found by the stem of its name among others."""
    folder = _scratch(spark, "tables").removesuffix(".csv")
    rows = raw(spark, sf_dir, "enterprise")
    write_delimited(rows.select(F.col("enterprisenumber").alias("Nummer")), f"{folder}/activiteiten.csv", delimiter=";")
    named = rows.select(F.col("enterprisenumber").alias("Ondernemingsnummer"), F.col("status").alias("Statuut"))
    write_delimited(named, f"{folder}/Ondernemingen 2001.csv", delimiter=";")
    return plain(load_enterprises(spark, folder))


@query
def provider_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    providers = Providers(Provider("YY", load=lambda *_: None), Provider("XX", load=_customers))
    return plain(providers.of(" xx ").records(spark, sf_dir))


# Orders


def _placed(ordered: DataFrame, *order: Column) -> DataFrame:
    """The rows of a short report with their places."""
    return ordered.withColumn("place", F.row_number().over(Window.orderBy(*order)))


@query
def leads_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best leads of all regions with their places."""
    rows = plan.lead_rows(registry(spark, sf_dir), params(postcodes=()))
    top = filters.top_scored(rows, 50)
    return _placed(top, F.desc("score_total"), F.col(ORDER)).select(*LEAD_COLUMNS, "place")


@query
def gaps_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 companies with most gaps, with their places."""
    tables = registry(spark, sf_dir)
    first = lookups.first_activity(tables.activity).withColumnRenamed("first_code", "nace")
    contacts = lookups.best_contacts(tables.contact, tables.establishment).drop("website")
    companies = attach(tables.enterprise.select(KEY, "start_date", ORDER), [first, contacts], KEY)
    top = gaps.by_gap_score(gaps.score_gaps(companies, datetime.combine(AS_OF, time()), 18)).limit(50)
    return plain(_placed(top, F.desc("score_total"), F.col(ORDER)).select(KEY, "sector", "score_total", "place", ORDER))


# Several snapshots, runs and rule tables


@query
def lead_run_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outputs of one run over all regions: the first 40 valid leads, and everything invalid."""
    run = plan.lead_run(registry(spark, sf_dir), params(postcodes=(), months=FLAGSHIP_MONTHS, limit=40))
    good = run.leads.withColumn(quality.REASON, F.lit(""))
    return good.unionByName(run.rejected).drop(ORDER)


@query
def address_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More first rows than an ordered limit takes."""
    return plain(filters.first_rows(_table(spark, sf_dir, "address"), 2 * filters.ORDERED_LIMIT))


@query
def sector_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sectors of all activities by rules that the parts make, some of them for the same prefix."""
    parts, heads = bindings.table(spark, sf_dir, "part"), bindings.CODE_HEADS
    prefix = F.concat(bindings.pick(heads, F.col("p_partkey")), bindings.pick(["", ".0", ",02", "02", "9"], F.col("p_size")))
    made = parts.where(F.col("p_partkey") % 8 > 1).select(prefix.alias("prefix"), F.col("p_brand").alias("sector"))
    rows = _table(spark, sf_dir, "activity")
    return plain(rules.with_sector(rows, made).select(KEY, "nace_code", "sector_bucket", ORDER))


def _number(column: str = KEY) -> Column:
    return F.substring(column, 2, 9).cast("int")


def _two_snapshots(spark: SparkSession, sf_dir: str, *tables: str) -> dict[str, plan.Registry]:
    """The bound registry without every fifth enterprise, and a later one without every third and with all stopped."""
    now = registry(spark, sf_dir, *tables)
    first = replace(now, enterprise=now.enterprise.where(_number() % 5 != 0), snapshot="2001-01")
    later = now.enterprise.where(_number() % 3 != 0).withColumn("status", F.lit("Stopped"))
    return {"2001-01": first, "2001-02": replace(now, enterprise=later, snapshot="2001-02")}


@query
def leads_of_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run over two snapshots, the second without every other enterprise."""
    first = registry(spark, sf_dir)
    second = replace(first, enterprise=first.enterprise.where(_number() % 2 == 0))
    return plan.build_leads(snapshots.combined({"2001-01": first, "2001-02": second}), params())


@query
def enterprise_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest known row of every enterprise; those that the second snapshot lacks are as in the first."""
    return plain(snapshots.as_of(_two_snapshots(spark, sf_dir, "enterprise", "establishment")).enterprise)


@query
def dedupe_three_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of three runs, over growing parts of the denominations, finds that no run before it had.

    Every row of an earlier run's part is in the later ones too. Rows that agree in name, address and the first run they
    are in are counted once, in one reading; a run then looks at these and adds up their counts.
    """
    names, parts = _table(spark, sf_dir, "denomination").withColumnRenamed("denomination", "name"), (6, 3, 1)
    first = F.coalesce(*[F.when(_number() % part == 0, step) for step, part in enumerate(parts, 1)])
    alike = ["name", F.col("language").alias("address"), first.alias("first")]
    rows = stage(names.select(*alike).where(F.col("first").isNotNull()).groupBy("name", "address", "first").agg(F.count("*").alias("n")))
    rows = rows.withColumn(ORDER, F.struct("first", "name", "address"))
    seen, out = SeenKeys(spark, _scratch(spark, "seen").removesuffix(".csv"), digits=1), None
    for step in range(1, len(parts) + 1):
        new = seen.unseen(rows.where(F.col("first") <= step)).where(F.col(dedupe.DEDUPE_KEY).isNotNull())
        new = stage(new.groupBy(dedupe.DEDUPE_KEY).agg(F.sum("n").alias("rows")))
        seen.add(new, str(step))
        found = new.select(F.lit(step).alias("step"), dedupe.DEDUPE_KEY, "rows")
        out = found if out is None else out.unionByName(found)
    return out
