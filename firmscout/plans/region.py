"""Region first: start from the addresses in the region and keep only what hangs on them.

The result differs from the normal run: only establishments with an address row
in the region count, so an enterprise placed by its own postcode or by its
establishment row alone is not found, and the primary establishment is chosen
among those in the region.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscout.functions.text import postal_code
from firmscout.operators.filters import by_score
from firmscout.operators.joins import keep_matching
from firmscout.operators.lookups import establishment_owner, fill, latest_address
from firmscout.plans.leads import KEY, LEAD_COLUMNS, Registry, candidates, lead_rows, rows_of
from firmscout.plans.params import LeadParams


@dataclass(frozen=True)
class Region:
    """A registry cut down to one region, and the key sets it was cut with."""

    registry: Registry
    establishments: DataFrame
    enterprises: DataFrame

    def sizes(self) -> tuple[int, int]:
        """How many establishments and enterprises have an address in the region; counts them."""
        return self.establishments.count(), self.enterprises.count()


def addresses_in(address: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Address rows of establishments whose postcode is in the region."""
    return address.where((F.col("establishment_number") != "") & postal_code(F.col("postal_code")).isin(list(codes)))


def region_prefilter(registry: Registry, codes: Sequence[str]) -> Region:
    """The registry cut down to one region by semi-joins. Contacts and denominations stay whole.

    Nothing runs yet; whether a key set is broadcast is Spark's choice by its bytes.
    """
    if registry.address is None:
        raise ValueError("the region-first run needs the address table")
    here = addresses_in(registry.address, codes)
    places = here.select("establishment_number").distinct()
    owned = registry.establishment.where(F.col(KEY) != "")
    establishment = keep_matching(owned, places, "establishment_number")
    owners = establishment.select(KEY).distinct()
    cut = replace(
        registry,
        address=here,
        establishment=establishment,
        enterprise=keep_matching(registry.enterprise, owners, KEY),
        activity=None if registry.activity is None else keep_matching(registry.activity, owners, KEY),
    )
    return Region(cut, places, owners)


def region_run(registry: Registry, params: LeadParams) -> tuple[Registry, DataFrame]:
    """The relations a region-first run needs, and its candidates.

    Equal to a normal run over ``region_prefilter``, without its semi-joins: the joins that a run has anyway, with the
    latest addresses and with the primary establishments, are inner ones here and leave only what is in the region.
    """
    if registry.address is None:
        raise ValueError("the region-first run needs the address table")
    here = addresses_in(registry.address, params.postcodes)
    latest = latest_address(here)
    placed = fill(registry.establishment.where(F.col(KEY) != ""), latest, how="inner")
    # Both have one row per establishment and come partitioned by it.
    owner = establishment_owner(registry.establishment).join(latest.select("establishment_number"), "establishment_number")
    cut = replace(registry, establishment=placed, address=None, owner=owner)
    return cut, candidates(cut, params, how="inner")


def region_lead_rows(registry: Registry, params: LeadParams) -> DataFrame:
    """Without a region there is nothing to cut, and the run is the normal one."""
    if not params.postcodes:
        return lead_rows(registry, params)
    cut, found = region_run(registry, params)
    return rows_of(cut, params, found)


def region_leads(registry: Registry, params: LeadParams) -> DataFrame:
    return by_score(region_lead_rows(registry, params)).select(*LEAD_COLUMNS)
