"""Header spellings: canonical names, collisions and synonyms, all at plan time."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns that sources add: the row order and the text of malformed rows.
OWN = ("_ord", "_corrupt_record")

# Canonical names that stand for another canonical name.
HEADER_ALIASES = {
    "zipcode": "postal_code",
    "municipalitynl": "city",
    "municipalityfr": "city_fr",
    "streetnl": "street",
    "housenumber": "house_number",
}


def plain_name(header: str) -> str:
    """Lower-case ASCII words of a header, joined by underscores."""
    letters = unicodedata.normalize("NFKD", header).lower()
    unmarked = "".join(c for c in letters if unicodedata.combining(c) == 0)
    return "_".join(re.findall("[a-z0-9]+", unmarked))


def canonical_name(header: str) -> str:
    name = plain_name(header)
    return HEADER_ALIASES.get(name, name)


def canonical_columns(df: DataFrame, naming=canonical_name) -> DataFrame:
    """Rename all columns; of columns that get the same name the last one stays.

    Our own columns, row order and corrupt text, are left alone.
    """
    headers = df.columns
    names = [h if h in OWN else naming(h) for h in headers]
    chosen = {name: f"c{position}" for position, name in enumerate(names)}
    positional = df.toDF(*[f"c{i}" for i in range(len(headers))])
    return positional.select(*chosen.values()).toDF(*chosen)


def first_present(columns: Iterable[str], names: Iterable[str]) -> str | None:
    """The first of ``names`` that is a column."""
    present = set(columns)
    return next((n for n in names if n in present), None)


def first_value(columns: Iterable[str], names: Iterable[str], keywords: Iterable[str] = ()) -> Column:
    """First value among the named columns, then among columns whose name holds a keyword.

    The frame's text is clean, so a missing value is null.
    """
    values = [F.col(c) for c in candidates(columns, names, keywords)]
    if not values:
        return F.lit(None).cast("string")
    return F.coalesce(*values) if len(values) > 1 else values[0]


def candidates(columns: Iterable[str], names: Iterable[str], keywords: Iterable[str] = ()) -> list[str]:
    """The columns that ``first_value`` looks at, in its order."""
    columns = [c for c in columns if c not in OWN]
    named = [n for n in names if n in columns]
    alike = [c for c in columns if any(w.lower() in c.lower() for w in keywords)]
    return list(dict.fromkeys([*named, *alike]))


def detect_columns(columns: Iterable[str], synonyms: Mapping[str, Iterable[str]]) -> dict[str, str]:
    """Source column to standard name: for each standard name its first synonym present and still free."""
    present = set(columns)
    renames: dict[str, str] = {}
    for standard, options in synonyms.items():
        free = [o for o in map(plain_name, options) if o in present and o not in renames]
        if free:
            renames[free[0]] = standard
    return renames
