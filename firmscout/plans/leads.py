"""From the six relations to scored leads.

The enterprises are first cut down by everything that needs only themselves and
their primary establishment, then contacts, names and first activities are
joined to them. The lists of all activity codes, whose size has no bound, are
built last, for the leads that are left. Building a frame starts no job.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscout.functions import scores
from firmscout.functions.dates import age_months, parse_date
from firmscout.functions.sectors import sector_of
from firmscout.functions.text import blank, is_active, postal_code, status_label, yes_no
from firmscout.operators import filters, lookups
from firmscout.operators.joins import ORDER, attach, stage
from firmscout.operators.keyfilter import MOST_PLACES, key_bits, may_hold, may_match, places_for
from firmscout.operators.quality import REASON, apply_policy, place_reason, reject_reason
from firmscout.plans.params import LeadParams

# The columns of a lead, in output order.
LEAD_COLUMNS = [
    "enterprise_number",
    "name",
    "status",
    "start_date",
    "address",
    "postal_code",
    "city",
    "nace_codes",
    "sector_bucket",
    "has_website",
    "website",
    "phone",
    "email",
    "score_total",
    "score_reasons",
    "source_files_version",
]

KEY = "enterprise_number"
#: Ends the tag of a key in a registry of several snapshots.
TAG_END = "|"
#: Places of the key filter of establishments, of which an enterprise may have many.
PLACE_KEYS = 1 << 24


@dataclass(frozen=True)
class Registry:
    """The mapped relations of one snapshot; optional ones may be absent.

    ``snapshot`` is the tag of all rows; none means that every key begins with its own tag (see ``plans.snapshots``).
    ``owner`` has the enterprise of every establishment whose contacts count, where these are not all establishments.
    ``is_cut`` says that the other tables hold only what may belong to its enterprises.
    """

    enterprise: DataFrame
    establishment: DataFrame
    address: DataFrame | None = None
    activity: DataFrame | None = None
    contact: DataFrame | None = None
    denomination: DataFrame | None = None
    snapshot: str | None = ""
    owner: DataFrame | None = None
    is_cut: bool = False


def located_enterprises(
    registry: Registry, enterprise: DataFrame | None = None, more: Sequence[DataFrame] = (), how: str = "left"
) -> DataFrame:
    """Enterprises with the place of their primary establishment, or else their own.

    With ``how`` inner only enterprises that have an establishment.

    ``own_postal_code``, ``est_postal_code`` and ``establishment_number`` stay for
    the diagnostics. ``more`` are further lookups by enterprise, joined with the
    same shuffle.
    """
    enterprise = registry.enterprise if enterprise is None else enterprise
    filled = lookups.filled_establishments(registry.establishment, registry.address)
    primary = lookups.primary_establishment(filled).withColumn("has_establishment", F.lit(True))
    joined = attach(enterprise, [primary, *more], KEY, how)
    own_code = postal_code(F.col("postal_code"))
    return joined.select(
        KEY,
        "name",
        "status",
        "start_date",
        "website",
        F.coalesce("est_address", "address").alias("address"),
        F.coalesce("est_postal_code", own_code).alias("postal_code"),
        F.coalesce("est_city", "city").alias("city"),
        own_code.alias("own_postal_code"),
        "est_postal_code",
        "establishment_number",
        F.coalesce("has_establishment", F.lit(False)).alias("has_establishment"),
        *[c for lookup in more for c in lookup.columns if c != KEY],
        ORDER,
    )


def eligible(registry: Registry, params: LeadParams) -> DataFrame:
    """Enterprises that their own row does not rule out: active, dated and young enough."""
    return filters.young(filters.dated(filters.active(registry.enterprise)), params.as_of, params.months)


def narrowed(registry: Registry, params: LeadParams) -> Registry:
    """The registry with only those activities and denominations that may belong to an eligible enterprise.

    The keys of the eligible enterprises are a Bloom filter, which the scan of a table tests before it computes
    anything else, so that no list is built and no row sorted or shuffled for enterprises that are closed or too old.
    """
    if registry.is_cut:
        return registry
    keys, cut = eligible(registry, params), {}
    if registry.activity is not None and not params.lite:
        cut["activity"] = may_match(registry.activity, keys, KEY)
    if registry.denomination is not None:
        cut["denomination"] = may_match(registry.denomination, keys, KEY)
    return replace(registry, **cut)


def narrowed_places(registry: Registry, params: LeadParams) -> Registry:
    """The registry with only the establishments, and their addresses, that may belong to an eligible enterprise.

    For the places of enterprises; whom an establishment belongs to (``lookups.establishment_owner``) all its rows tell.
    """
    establishment = may_match(registry.establishment, eligible(registry, params), KEY)
    if registry.address is None:
        return replace(registry, establishment=establishment)
    number = "establishment_number"
    return replace(registry, establishment=establishment, address=may_match(registry.address, establishment, number, places=PLACE_KEYS))


def cut_down(registry: Registry, params: LeadParams) -> Registry:
    """The registry with only the rows that leads may be made from; a run over it has the same leads.

    Starts jobs: the eligible enterprises are computed once, written and counted, and key filters made from what was
    written are tested in the scans of all other tables, so that nothing else is sorted or shuffled. The owner of an
    establishment is the one its last row names, so all rows of those that any eligible enterprise ever had are kept for it.

    The filters are computed once and written as well. A filter is a value in the plan, and a plan goes along, through
    the driver, with the tasks of every stage above it, with all that its filters are computed from.
    """
    number, enterprise = "establishment_number", stage(eligible(registry, params))
    keys = min(MOST_PLACES, 4 * places_for(enterprise.count()))
    mine, places = key_bits(enterprise, KEY, keys, once=True), min(PLACE_KEYS, 4 * keys)
    theirs = registry.establishment.where(may_hold(mine, F.col(KEY), keys))
    held = key_bits(theirs, number, places, once=True)
    cut = {"enterprise": enterprise, "establishment": theirs}
    if registry.address is not None:
        cut["address"] = registry.address.where(may_hold(held, F.col(number), places))
    for table in ("activity", "denomination"):
        rows = getattr(registry, table)
        if rows is not None and not (table == "activity" and params.lite):
            cut[table] = rows.where(may_hold(mine, F.col(KEY), keys))
    if registry.contact is not None:
        entity = F.col("entity_number")
        cut["contact"] = registry.contact.where(may_hold(mine, entity, keys) | may_hold(held, entity, places))
        if registry.owner is None:
            once_theirs = registry.establishment.where(may_hold(held, F.col(number), places))
            cut["owner"] = lookups.establishment_owner(once_theirs)
    return replace(registry, **cut, is_cut=True)


def candidates(registry: Registry, params: LeadParams, how: str = "left", narrow: bool = False) -> DataFrame:
    """Active, dated, young enough and in the region and city asked for; ``narrow`` cuts down what they are joined with.

    A key filter reads the enterprises once more, so a plain run over one snapshot goes without; a run over several
    (``snapshot`` none) and one that returns all its rows use it.
    """
    places = narrowed_places(registry, params) if narrow or registry.snapshot is None else registry
    located = located_enterprises(places, eligible(registry, params), how=how)
    placed = filters.in_region(located, params.postcodes)
    return with_age(filters.in_city(placed, params.city), params)


def with_age(found: DataFrame, params: LeadParams) -> DataFrame:
    started = found.withColumn("_started", parse_date(F.col("start_date")))
    return started.withColumn("age_months", age_months(F.col("_started"), params.as_of)).drop("_started")


def with_details(found: DataFrame, registry: Registry, lite: bool = False) -> DataFrame:
    """Contacts, names and first activity codes of the enterprises found."""
    details: list[DataFrame] = []
    if registry.contact is not None:
        contacts = lookups.best_contacts(registry.contact, registry.establishment, registry.owner)
        details.append(contacts.withColumnRenamed("website", "contact_website"))
    if registry.denomination is not None:
        details.append(lookups.best_denomination(registry.denomination))
    if registry.activity is not None and not lite:
        details.append(lookups.first_activity(registry.activity))
    if details:
        found = attach(found, details, KEY)
    names = ["phone", "email", "contact_website", "denomination", "first_code", "nace_codes"]
    return found.withColumns({n: F.lit(None).cast("string") for n in names if n not in found.columns})


def with_codes(leads: DataFrame, registry: Registry, lite: bool = False) -> DataFrame:
    """Leads with the list of all their activity codes, in file order.

    Lists are built below the join, per key and chunk of the table first, so a lead with a third of all activities is
    one list per chunk before it is one list; ``registry.activity`` comes narrowed to keys that may be leads. What is
    joined is one row per key. A list is one cell and as such ends at two gigabytes, with an error.
    """
    if registry.activity is None or lite:
        return leads
    lists = lookups.activity_codes(registry.activity).select(KEY, "nace_codes")
    return attach(leads.drop("nace_codes"), [lists], KEY).withColumn("nace_codes", blank(F.col("nace_codes"))).select(*leads.columns)


def scored(found: DataFrame, params: LeadParams, snapshot: str | None) -> DataFrame:
    """Lead columns with score and reasons; missing values become empty text."""
    tag = F.substring_index(KEY, TAG_END, 1) if snapshot is None else F.lit(snapshot)
    website = F.coalesce("contact_website", "website")
    phone, email = F.col("phone"), F.col("email")
    if params.lite:
        sector, total = F.lit(""), F.lit(0)
        why = scores.lite_reasons(phone, email, website)
    else:
        sector = sector_of(F.col("first_code"))
        rules = scores.lead_rules(
            F.col("age_months"), params.months, sector, F.col("first_code"), phone, email, website
        )
        total, why = scores.lead_score(rules), scores.reasons(rules)
    columns = {
        "name": F.coalesce("name", "denomination"),
        "status": status_label(F.col("status")),
        "sector_bucket": sector,
        "has_website": yes_no(website.isNotNull()),
        "website": website,
        "score_total": total.cast("int"),
        "score_reasons": why,
        "source_files_version": tag,
    }
    out = [columns.get(c, F.col(c)) for c in LEAD_COLUMNS]
    text = [c if n == "score_total" else blank(c) for c, n in zip(out, LEAD_COLUMNS)]
    return found.select(*[c.alias(n) for c, n in zip(text, LEAD_COLUMNS)], ORDER)


@dataclass(frozen=True)
class LeadRun:
    """The leads of a run and the rows that are not valid, with their reasons; both with ``_ord``.

    ``staged`` says that both are read from where they were written already.
    """

    leads: DataFrame
    rejected: DataFrame
    staged: bool = False


def without_tags(leads: DataFrame, registry: Registry) -> DataFrame:
    """Leads under their own numbers, also where keys carry the tag of their snapshot."""
    return leads.withColumn(KEY, F.substring_index(KEY, TAG_END, -1)) if registry.snapshot is None else leads


def scored_leads(registry: Registry, params: LeadParams, found: DataFrame | None = None) -> DataFrame:
    """Scored leads after all filters but before validity and limit, without code lists."""
    tables = narrowed(registry, params) if found is None or registry.snapshot is None else registry
    found = candidates(registry, params, narrow=True) if found is None else found
    details = with_details(found, tables, params.lite)
    leads = filters.mentions(scored(details, params, registry.snapshot), params.query)
    return filters.scored_at_least(leads, params.score_floor)


def all_leads(registry: Registry, params: LeadParams) -> DataFrame:
    """Scored leads after all filters but before validity and limit, in no order, with ``_ord``."""
    return without_tags(with_codes(scored_leads(registry, params), narrowed(registry, params), params.lite), registry)


def lead_rows(registry: Registry, params: LeadParams) -> DataFrame:
    """The leads of a run with ``_ord``: valid ones, the first ``limit`` of them in file order.

    The limit comes before contacts, names and codes are looked up if none of
    these can reject a row any more: scores are clamped to the valid range.
    """
    return rows_of(registry, params, candidates(registry, params))


def rows_of(registry: Registry, params: LeadParams, found: DataFrame) -> DataFrame:
    """The leads among the candidates found."""
    if params.limit and params.on_invalid != "fail" and not params.query.strip() and not params.score_floor:
        found = filters.first_rows(found.where(place_reason().isNull()), params.limit)
    valid = apply_policy(scored_leads(registry, params, found), params.on_invalid)
    first = filters.first_rows(valid, params.limit)
    return without_tags(with_codes(first, narrowed(registry, params), params.lite), registry)


def lead_run(registry: Registry, params: LeadParams) -> LeadRun:
    """The leads of a run, and what it rejects as invalid; runs and writes both.

    Scored leads are computed and written once, with the reason that makes them invalid, and both outputs are parts of
    that. Code lists are built for what is left of either, once, from the activities whose keys are among it. With
    ``fail`` one invalid row is an error; with ``drop`` nothing is returned as rejected.
    """
    checked = scored_leads(registry, params)
    if params.on_invalid == "fail":
        checked = apply_policy(checked, params.on_invalid)
    checked = stage(checked.withColumn(REASON, reject_reason()))
    kept = filters.first_rows(checked.where(F.col(REASON).isNull()), params.limit)
    if params.on_invalid == "quarantine":
        kept = kept.unionByName(checked.where(F.col(REASON).isNotNull()))
    if registry.activity is not None and not params.lite:
        wanted = replace(registry, activity=may_match(registry.activity, kept, KEY))
        kept = stage(with_codes(kept, wanted))
    kept = without_tags(kept, registry)
    valid = F.col(REASON).isNull()
    return LeadRun(kept.where(valid).drop(REASON), kept.where(~valid), staged=True)


def build_leads(registry: Registry, params: LeadParams) -> DataFrame:
    """The lead table: sixteen columns, highest score first."""
    return filters.by_score(lead_rows(registry, params)).select(*LEAD_COLUMNS)


def flagged_enterprises(registry: Registry, params: LeadParams) -> DataFrame:
    """Every enterprise with one flag per stage, for funnels and coverage."""
    if registry.contact is None:
        placed = located_enterprises(registry).withColumn("has_contact", F.lit(False))
    else:
        contacts = lookups.best_contacts(registry.contact, registry.establishment)
        placed = located_enterprises(registry, more=[contacts.select(KEY, F.lit(True).alias("has_contact"))])
    return placed.select(
        KEY,
        "status",
        "start_date",
        "postal_code",
        is_active(F.col("status")).alias("is_active"),
        F.col("start_date").isNotNull().alias("is_dated"),
        "has_establishment",
        F.coalesce("has_contact", F.lit(False)).alias("has_contact"),
        filters.region_test(params.postcodes).alias("is_in_region"),
        ORDER,
    )
