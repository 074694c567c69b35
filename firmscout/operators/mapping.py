"""Raw tables with any header spelling to the six relations.

Every ``map_*`` takes a frame with canonical column names and an ``_ord`` column
and returns the relation's columns plus ``_ord``; missing values are null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmscout.functions.text import cleaned, digits
from firmscout.operators.joins import ORDER
from firmscout.sources.headers import candidates, first_value

# Accepted column names per logical field, first match first.
ENTERPRISE_ID = ["enterprise_number", "enterprisenumber", "entity_number"]
ENTERPRISE_FIELDS = {
    "name": ["name", "denomination", "denomination_nl", "denomination_fr", "legal_name", "tradename"],
    "status": ["status", "enterprise_status"],
    "start_date": ["start_date", "startdate", "creation_date"],
    "postal_code": ["postal_code", "postcode", "post_code"],
    "city": ["city", "municipality", "municipality_nl", "municipality_fr"],
    "address": ["address", "street", "street_name"],
    "website": ["website", "web", "url"],
}
ESTABLISHMENT_ID = ["establishment_number", "establishmentnumber", "entity_number"]
STREET = ["street", "street_nl", "street_fr", "street_de", "street_name"]
HOUSE = ["house_number", "housenumber", "number"]
BOX = ["box", "bus", "box_number"]
WHOLE_ADDRESS = ["address", "full_address"]
POSTCODE = ["postal_code", "postcode", "post_code", "zip_code", "zip"]
CITY = ["city", "municipality", "municipality_nl", "municipality_fr", "municipality_de", "commune"]
ADDRESS_ID = ["establishment_number", "establishmentnumber", "entitynumber", "entity_number"]
ACTIVITY_ID = ["enterprise_number", "enterprisenumber", "entity_number", "entitynumber"]
ACTIVITY_CODE = ["nace_code", "nace", "activity_code", "nacecode"]
CONTACT_ID = ["entitynumber", "entity_number", "enterprise_number", "establishment_number"]
CONTACT_OWNER = ["entitycontact", "entity_contact"]
CONTACT_TYPE = ["contacttype", "contact_type"]
DENOMINATION_ID = ["entity_number", "enterprise_number", "entitynumber"]
DENOMINATION_NAME = ["denomination", "name"]
DENOMINATION_TYPE = ["type_of_denomination", "typeofdenomination"]
DENOMINATION_LANGUAGE = ["language", "language_code", "lang"]
STREET_WORDS, HOUSE_WORDS = ["street"], ["house"]
POSTCODE_WORDS, CITY_WORDS = ["postcode", "postalcode", "post_code"], ["municipality", "city"]
# The box marker inside an address.
BOX_MARK = "box "


def build_address(have: list[str]) -> dict[str, Column]:
    """Address line, postcode and city of a row, from parts or from a whole address, given the columns."""
    street = first_value(have, STREET, STREET_WORDS)
    house = first_value(have, HOUSE, HOUSE_WORDS)
    box = first_value(have, BOX)
    whole = first_value(have, WHOLE_ADDRESS)
    line = F.concat_ws(" ", street, house, F.concat(F.lit(BOX_MARK), box))
    only_box = street.isNull() & house.isNull()
    return {
        "address": F.when(street.isNull() & whole.isNotNull(), whole)
        .when(only_box, box)
        .otherwise(line),
        "postal_code": first_value(have, POSTCODE, POSTCODE_WORDS),
        "city": first_value(have, CITY, CITY_WORDS),
    }


def clean_text(raw: DataFrame) -> DataFrame:
    return cleaned(raw, [c for c in raw.columns if not c.startswith("_")])


def with_digits(raw: DataFrame, **names: tuple[list[str], ...]) -> DataFrame:
    """Clean text beside identifiers, each under its name with an underscore, from the first of some columns.

    White space is no digit, so an identifier that one column alone can hold is made from that column as it is: a filter
    on the identifier that moves into the scan then has no text to strip.
    """
    have = raw.columns
    held = {name: candidates(have, *of) for name, of in names.items()}
    alone = {f"_{name}": digits(F.col(of[0])) for name, of in held.items() if len(of) == 1}
    rest = {f"_{name}": digits(first_value(have, *names[name])) for name, of in held.items() if len(of) != 1}
    return clean_text(raw.withColumns(alone)).withColumns(rest)


def _select(raw: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return raw.select(*[c.alias(name) for name, c in columns.items()], ORDER)


def map_enterprise(raw: DataFrame) -> DataFrame:
    raw, have = with_digits(raw, enterprise_number=(ENTERPRISE_ID,)), raw.columns
    fields = {name: first_value(have, names) for name, names in ENTERPRISE_FIELDS.items()}
    return _select(raw, {"enterprise_number": F.col("_enterprise_number"), **fields})


def map_establishment(raw: DataFrame) -> DataFrame:
    numbers = {"enterprise_number": (ENTERPRISE_ID,), "establishment_number": (ESTABLISHMENT_ID,)}
    raw, have = with_digits(raw, **numbers), raw.columns
    return _select(raw, {**{n: F.col(f"_{n}") for n in numbers}, **build_address(have)})


def map_address(raw: DataFrame) -> DataFrame:
    raw, have = with_digits(raw, establishment_number=(ADDRESS_ID, ["establishment"])), raw.columns
    return _select(raw, {"establishment_number": F.col("_establishment_number"), **build_address(have)})


def map_activity(raw: DataFrame) -> DataFrame:
    raw, have = with_digits(raw, enterprise_number=(ACTIVITY_ID,)), raw.columns
    return _select(
        raw,
        {"enterprise_number": F.col("_enterprise_number"), "nace_code": first_value(have, ACTIVITY_CODE)},
    )


def map_contact(raw: DataFrame) -> DataFrame:
    """Tall (type, value) and wide (phone, email, website) contact rows in one shape."""
    raw, have = with_digits(raw, entity_number=(CONTACT_ID,)), raw.columns
    return _select(
        raw,
        {
            "entity_number": F.col("_entity_number"),
            "entity_contact": F.upper(first_value(have, CONTACT_OWNER)),
            "contact_type": F.upper(first_value(have, CONTACT_TYPE)),
            "value": first_value(have, ["value"]),
            "phone": first_value(have, ["phone"]),
            "email": first_value(have, ["email"]),
            "website": first_value(have, ["website", "web"]),
        },
    )


def map_denomination(raw: DataFrame) -> DataFrame:
    raw, have = with_digits(raw, enterprise_number=(DENOMINATION_ID,)), raw.columns
    return _select(
        raw,
        {
            "enterprise_number": F.col("_enterprise_number"),
            "denomination": first_value(have, DENOMINATION_NAME),
            "type": first_value(have, DENOMINATION_TYPE),
            "language": F.lower(first_value(have, DENOMINATION_LANGUAGE)),
        },
    )


MAPPERS = {
    "enterprise": map_enterprise,
    "establishment": map_establishment,
    "address": map_address,
    "activity": map_activity,
    "contact": map_contact,
    "denomination": map_denomination,
}
