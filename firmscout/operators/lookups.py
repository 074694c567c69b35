"""One row per key: addresses, owners, primary establishments, contacts, names, codes.

All but the code list are a minimum or maximum of order and value, which combine
map-side: a key with a third of all rows sends one row per input task. The row
order inside a table is its ``_ord``.

Rows without a key or a value have a null position there and so never win. As a
filter the test would be pushed below the columns it is about, and these would
be computed twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmscout.functions.text import postal_code
from firmscout.operators.joins import ORDER, attach

# Owner flags, contact types and the ranks of name types and languages.
ESTABLISHMENT_FLAGS = ["EST", "ESTABLISHMENT", "VESTIGING"]
TYPED_CONTACTS = {"phone": "TEL", "email": "EMAIL", "website": "WEB"}
UNUSED_CONTACTS = ["FAX"]
NAME_TYPE_RANKS = {"001": 0, "1": 0, "002": 1, "2": 1}
OTHER_TYPE_RANK = 2
LANGUAGE_RANKS = {"nl": 0, "n": 0, "fr": 1, "f": 1, "en": 2, "e": 2, "de": 3, "d": 3}
OTHER_LANGUAGE_RANK = 4

ADDRESS_COLUMNS = ["address", "postal_code", "city"]
CONTACT_COLUMNS = list(TYPED_CONTACTS)


def _rank(column: str, ranks: dict[str, int], default: int):
    """Rank of a value by a fixed table; unknown and missing values get the default."""
    by_rank: dict[int, list[str]] = {}
    for value, rank in ranks.items():
        by_rank.setdefault(rank, []).append(value)
    tests = [F.when(F.col(column).isin(values), F.lit(rank)) for rank, values in by_rank.items()]
    return F.coalesce(*tests, F.lit(default))


def _paired(order: Column, value: Column) -> Column:
    """A value behind what decides about it: one minimum or maximum of both costs less than one that ``min_by`` keeps in step.

    Equal orders are decided by the value, so by no partitioning.
    """
    return F.when(order.isNotNull(), F.struct(order.alias("order"), value.alias("value")))


def first_by(value: Column, order: Column) -> Column:
    """The value of the least ``order``, of rows that have one."""
    return F.min(_paired(order, value))["value"]


def last_by(value: Column, order: Column) -> Column:
    """The value of the greatest ``order``, of rows that have one."""
    return F.max(_paired(order, value))["value"]


def is_address() -> Column:
    """Whether an address row has a key and says at least a street or a postcode."""
    useful = F.col("address").isNotNull() | F.col("postal_code").isNotNull()
    return (F.col("establishment_number") != "") & useful


def latest_address(address: DataFrame) -> DataFrame:
    """Per establishment the last address row in file order."""
    last = address.groupBy("establishment_number").agg(
        last_by(F.struct(*ADDRESS_COLUMNS), F.when(is_address(), F.col(ORDER))).alias("_last")
    )
    found = last.where(F.col("_last").isNotNull())
    return found.select("establishment_number", *[F.col(f"_last.{c}").alias(c) for c in ADDRESS_COLUMNS])


def fill(establishment: DataFrame, latest: DataFrame, how: str = "left") -> DataFrame:
    """Establishments whose empty address, postcode and city come from ``latest``; with ``how`` inner only those in it."""
    extra = latest.withColumnsRenamed({c: f"_{c}" for c in ADDRESS_COLUMNS})
    joined = attach(establishment, [extra], "establishment_number", how)
    filled = {c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in ADDRESS_COLUMNS}
    return joined.withColumns(filled).select(*establishment.columns)


def filled_establishments(establishment: DataFrame, address: DataFrame | None) -> DataFrame:
    """Establishments whose empty address, postcode and city come from the address table."""
    return establishment if address is None else fill(establishment, latest_address(address))


def primary_establishment(establishment: DataFrame) -> DataFrame:
    """Per enterprise: one with a postcode before one without, then with an address, then the first seen."""
    preference = F.struct(F.col("postal_code").isNull(), F.col("address").isNull(), F.col(ORDER))
    columns = ["establishment_number", *ADDRESS_COLUMNS]
    owned = F.when(F.col("enterprise_number") != "", preference)
    best = establishment.groupBy("enterprise_number").agg(first_by(F.struct(*columns), owned).alias("_best"))
    return best.where(F.col("_best").isNotNull()).select(
        "enterprise_number",
        F.col("_best.establishment_number").alias("establishment_number"),
        F.col("_best.address").alias("est_address"),
        postal_code(F.col("_best.postal_code")).alias("est_postal_code"),
        F.col("_best.city").alias("est_city"),
    )


def establishment_owner(establishment: DataFrame) -> DataFrame:
    """Per establishment the enterprise named by its last row."""
    known = (F.col("establishment_number") != "") & (F.col("enterprise_number") != "")
    last = establishment.groupBy("establishment_number").agg(
        last_by(F.col("enterprise_number"), F.when(known, F.col(ORDER))).alias("enterprise_number")
    )
    return last.where(F.col("enterprise_number").isNotNull())


def contact_values(contact: DataFrame) -> DataFrame:
    """Contact rows with their phone, email and website, and whether they belong to an establishment.

    A typed row carries its value in one column; a row of any other type carries
    them side by side. Fax rows carry nothing we use, but still count as a contact.
    """
    kind = F.col("contact_type")
    typed = F.coalesce(kind.isin([*TYPED_CONTACTS.values(), *UNUSED_CONTACTS]), F.lit(False))
    values = {
        column: F.when(typed, F.when(kind == name, F.col("value"))).otherwise(F.col(column))
        for column, name in TYPED_CONTACTS.items()
    }
    of_establishment = F.coalesce(F.col("entity_contact").isin(ESTABLISHMENT_FLAGS), F.lit(False))
    return contact.select(
        "entity_number",
        of_establishment.alias("of_establishment"),
        *[c.alias(name) for name, c in values.items()],
        ORDER,
    )


def resolve_contacts(contact: DataFrame, establishment: DataFrame) -> DataFrame:
    """Each contact row with the enterprise it belongs to; rows without one are dropped."""
    rows = contact_values(contact).where(F.col("entity_number") != "")
    columns = ["enterprise_number", *CONTACT_COLUMNS, ORDER]
    own = rows.where(~F.col("of_establishment")).withColumnRenamed("entity_number", "enterprise_number")
    theirs = rows.where("of_establishment").withColumnRenamed("entity_number", "establishment_number")
    owned = attach(theirs, [establishment_owner(establishment)], "establishment_number")
    owned = owned.where(F.col("enterprise_number").isNotNull())
    return own.select(*columns).unionByName(owned.select(*columns))


def _positioned(rows: DataFrame, key: str) -> DataFrame:
    """Contact rows keyed by ``key``, each value paired with its position."""
    pairs = [
        F.when(F.col(c).isNotNull(), F.struct(F.col(ORDER), F.col(c).alias("value"))).alias(c)
        for c in CONTACT_COLUMNS
    ]
    return rows.select(F.col("entity_number").alias(key), *pairs)


def best_contacts(contact: DataFrame, establishment: DataFrame, owner: DataFrame | None = None) -> DataFrame:
    """Per enterprise the first phone, email and website in file order.

    Contacts of establishments are first reduced to one row per establishment, so
    the join with the owners meets no frequent key; the position of each value
    travels along, and the final minimum is the same as over the single rows.
    Of those without a key one row is left, which no owner matches; a test on the
    key would be carried over to the owners and compute their keys a second time.
    """
    rows = contact_values(contact)
    owner = establishment_owner(establishment) if owner is None else owner
    earliest = [F.min(c).alias(c) for c in CONTACT_COLUMNS]
    own = _positioned(rows.where(~F.col("of_establishment") & (F.col("entity_number") != "")), "enterprise_number")
    theirs = _positioned(rows.where("of_establishment"), "establishment_number")
    owned = theirs.groupBy("establishment_number").agg(*earliest).join(owner, "establishment_number")
    merged = own.unionByName(owned.drop("establishment_number")).groupBy("enterprise_number").agg(*earliest)
    return merged.select("enterprise_number", *[F.col(f"{c}.value").alias(c) for c in CONTACT_COLUMNS])


def is_denomination() -> Column:
    return (F.col("enterprise_number") != "") & F.col("denomination").isNotNull()


def best_denomination(denomination: DataFrame) -> DataFrame:
    """Per enterprise the name of the best type, then the best language, then the first seen."""
    preference = F.struct(
        _rank("type", NAME_TYPE_RANKS, OTHER_TYPE_RANK),
        _rank("language", LANGUAGE_RANKS, OTHER_LANGUAGE_RANK),
        F.col(ORDER),
    )
    best = denomination.groupBy("enterprise_number").agg(
        first_by(F.col("denomination"), F.when(is_denomination(), preference)).alias("denomination")
    )
    return best.where(F.col("denomination").isNotNull())


def is_activity() -> Column:
    return (F.col("enterprise_number") != "") & F.col("nace_code").isNotNull()


def first_activity(activity: DataFrame) -> DataFrame:
    """Per enterprise its first activity code; combines map-side."""
    first = activity.groupBy("enterprise_number").agg(
        first_by(F.col("nace_code"), F.when(is_activity(), F.col(ORDER))).alias("first_code")
    )
    return first.where(F.col("first_code").isNotNull())


def activity_codes(activity: DataFrame) -> DataFrame:
    """Per enterprise all activity codes in file order, duplicates kept, joined by commas.

    Two steps, so that no task sorts a whole group: codes are joined per chunk of
    the table (``_ord.chunk``, a bounded run of rows), then the pieces of an
    enterprise are put in chunk order. What is left for the last step is the text
    of the cell itself and one position per chunk.
    """
    row = F.when(is_activity(), F.struct(F.col(ORDER), F.col("nace_code")))
    pieces = (
        activity.groupBy("enterprise_number", F.col(f"{ORDER}.chunk").alias("chunk"))
        .agg(F.sort_array(F.collect_list(row)).alias("rows"))
        .where(F.size("rows") > 0)
        .select("enterprise_number", "chunk", F.col("rows.nace_code").alias("codes"))
        .select(
            "enterprise_number",
            F.struct(
                "chunk", F.array_join("codes", ",").alias("codes"), F.col("codes")[0].alias("first_code")
            ).alias("piece"),
        )
    )
    whole = pieces.groupBy("enterprise_number").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    return whole.select(
        "enterprise_number",
        F.array_join("pieces.codes", ",").alias("nace_codes"),
        F.col("pieces")[0]["first_code"].alias("first_code"),
    )
