"""Several snapshots of the registry in one frame.

Either every snapshot is a registry of its own, and one run yields the leads of all of them: the tag of the snapshot goes
into every key, so that no join meets rows of two snapshots. Or the snapshots are the past of one registry, which is
looked at as of the last one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmscout.operators.joins import ORDER, is_blank, keep_matching
from firmscout.plans.leads import TAG_END, Registry

RELATIONS = ["enterprise", "establishment", "address", "activity", "contact", "denomination"]
KEYS = ["enterprise_number", "establishment_number", "entity_number"]
#: What the rows of a relation are about: the first of these that a row names.
SUBJECT = {
    "enterprise": ["enterprise_number"],
    "establishment": ["establishment_number", "enterprise_number"],
    "address": ["establishment_number"],
    "activity": ["enterprise_number"],
    "contact": ["entity_number"],
    "denomination": ["enterprise_number"],
}
_TAG, _STATE, _LAST = "_tag", "_state", "_last"


def _placed(rows: DataFrame, tag: str) -> DataFrame:
    """Rows whose order begins with the tag, so that the rows of one snapshot follow those of the one before."""
    chunk = F.struct(F.lit(tag).alias("tag"), F.col(f"{ORDER}.chunk").alias("chunk"))
    return rows.withColumn(ORDER, F.struct(chunk.alias("chunk"), F.col(ORDER).alias("row")))


def _stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda done, part: done.unionByName(part, allowMissingColumns=True), parts)


def _checked(snapshots: dict[str, Registry]) -> dict[str, Registry]:
    if not snapshots:
        raise ValueError("no snapshots")
    wrong = [tag for tag in snapshots if not tag or TAG_END in tag or tag.startswith("~")]
    if wrong:
        raise ValueError(f"not a snapshot tag: {', '.join(map(repr, wrong))}")
    return dict(sorted(snapshots.items()))


def combined(snapshots: dict[str, Registry]) -> Registry:
    """The snapshots by tag as one registry with the tag in every key; a run over it yields the leads of each.

    Leads come out with their own numbers and the tag in ``source_files_version``. A relation that some snapshots lack
    has no rows for these.
    """
    def keyed(rows: DataFrame, tag: str) -> DataFrame:
        own = [c for c in KEYS if c in rows.columns]
        tagged = {c: F.when(is_blank(F.col(c)), F.col(c)).otherwise(F.concat(F.lit(tag + TAG_END), c)) for c in own}
        return _placed(rows.withColumns(tagged), tag)

    tables = {}
    for name in RELATIONS:
        parts = [keyed(rows, tag) for tag, one in _checked(snapshots).items() if (rows := getattr(one, name)) is not None]
        if parts:
            tables[name] = _stacked(parts)
    return Registry(**tables, snapshot=None)


def _subject(name: str) -> Column:
    named = [F.when(~is_blank(F.col(c)), F.col(c)) for c in SUBJECT[name]]
    return F.coalesce(*named, F.lit(""))


def as_of(snapshots: dict[str, Registry], tag: str | None = None) -> Registry:
    """The latest known state of everything, up to the snapshot ``tag`` (default the last).

    An enterprise, establishment or contact has the rows of the last snapshot that mentions it at all, and none of earlier
    ones; what later snapshots no longer mention stays as it was. Rows that name nothing count as one thing. The latest
    snapshots are found per key, map-side first, and kept by a semi-join, which splits frequent keys.
    """
    known = {t: one for t, one in _checked(snapshots).items() if tag is None or t <= tag}
    if not known:
        raise ValueError(f"no snapshot up to {tag!r}")
    tables = {}
    for name in RELATIONS:
        parts = [
            _placed(rows, t).withColumn(_TAG, F.lit(t)) for t, one in known.items() if (rows := getattr(one, name)) is not None
        ]
        if parts:
            rows = _stacked(parts).withColumn(_LAST, _subject(name))
            last = rows.groupBy(_LAST).agg(F.max(_TAG).alias(_TAG))
            state = F.concat(_TAG, F.lit(TAG_END), _LAST)
            kept = keep_matching(rows.withColumn(_STATE, state), last.select(state.alias(_STATE)), _STATE)
            tables[name] = kept.drop(_TAG, _STATE, _LAST)
    return Registry(**tables, snapshot=max(known))
