"""Whole snapshots and single multilingual tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmscout.operators.joins import ORDER
from firmscout.operators.mapping import MAPPERS
from firmscout.plans.leads import Registry
from firmscout.sources.delimited import read_delimited
from firmscout.sources.files import TABLE_FILES, path_by_stem, snapshot_folder, table_path
from firmscout.sources.headers import canonical_columns, detect_columns, plain_name

# Standard columns and their synonyms in English, Dutch and French.
SYNONYMS = {
    "enterprise_number": [
        "enterprise_number",
        "enterprise",
        "enterprise_no",
        "enterprise_nr",
        "ondernemingsnummer",
        "num_entreprise",
        "numero_entreprise",
        "company_number",
    ],
    "status": ["status", "legal_status", "enterprise_status", "statuut", "etat"],
    "start_date": [
        "start_date",
        "startdate",
        "date_start",
        "activity_start_date",
        "begin_date",
        "begindatum",
        "datum_start",
    ],
    "postal_code": ["postal_code", "zip", "zipcode", "postcode", "code_postal"],
    "city": ["city", "municipality", "gemeente", "locality", "ville", "stad"],
    "street": ["street", "street_name", "straat", "rue", "road"],
    "number": ["number", "house_number", "box_number", "nr", "num", "bus"],
    "nace_code": ["nace_code", "nace", "nacebel", "activity_code", "code_nace"],
}
# Texts that stand for a missing value in multilingual tables.
MISSING_TEXTS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
REQUIRED = ["enterprise", "establishment"]


def raw_table(spark: SparkSession, path: str, **options) -> DataFrame:
    """A delimited table under canonical column names, plus ``_ord``."""
    return canonical_columns(read_delimited(spark, path, **options))


def registry_of(raw: dict[str, DataFrame], snapshot: str) -> Registry:
    """Map raw tables (canonical names, ``_ord``) to the relations of a registry."""
    missing = [name for name in REQUIRED if name not in raw]
    if missing:
        raise ValueError(f"missing tables: {', '.join(missing)}")
    return Registry(**{name: MAPPERS[name](df) for name, df in raw.items()}, snapshot=snapshot)


def load_snapshot(
    spark: SparkSession, path: str, *, lite: bool = False, work_dir: str | None = None, **options
) -> Registry:
    """All tables of a snapshot folder. Address, contact and denomination may be absent or empty.

    The activity table is required, but a ``lite`` load does not look for it. With
    ``work_dir``, a folder all executors share, the mapped tables are written there
    as Parquet once and read from it: text is then parsed once, however often a
    run reads a table, and reads take only the columns they need.
    """
    folder = snapshot_folder(spark, path)
    raw: dict[str, DataFrame] = {}
    for table, names in TABLE_FILES.items():
        if table == "activity" and lite:
            continue
        try:
            found = table_path(folder, names)
        except FileNotFoundError:
            if table in [*REQUIRED, "activity"]:
                raise
            continue
        raw[table] = raw_table(spark, found, may_be_empty=table not in [*REQUIRED, "activity"], **options)
    registry = registry_of(raw, snapshot_tag(folder.path))
    return registry if work_dir is None else converted(spark, registry, work_dir)


def load_snapshots(spark: SparkSession, paths: Sequence[str], **options) -> dict[str, Registry]:
    """Several snapshot folders by their tags, for ``plans.snapshots``; no two may have the same tag."""
    found = [load_snapshot(spark, path, **options) for path in paths]
    tags = [registry.snapshot for registry in found]
    if len(set(tags)) < len(tags):
        raise ValueError(f"snapshots with the same tag: {', '.join(sorted(tags))}")
    return dict(zip(tags, found))


def converted(spark: SparkSession, registry: Registry, work_dir: str) -> Registry:
    """The same registry over Parquet files in ``work_dir``; a table that is there is replaced."""
    tables = {}
    for table in TABLE_FILES:
        rows = getattr(registry, table)
        if rows is not None:
            path = f"{work_dir.rstrip('/')}/{table}.parquet"
            rows.write.mode("overwrite").parquet(path)
            tables[table] = spark.read.parquet(path)
    return replace(registry, **tables)


def snapshot_tag(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def load_multilingual(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A semicolon table found by stem, synonyms renamed to the standard names, plus ``_ord``."""
    found = path_by_stem(spark, path, kind)
    table = canonical_columns(read_delimited(spark, found, delimiter=";"), plain_name)
    columns = [c for c in table.columns if c != ORDER]
    known = table.select(
        *[F.when(~F.col(c).isin(MISSING_TEXTS), F.col(c)).alias(c) for c in columns], ORDER
    )
    return known.withColumnsRenamed(detect_columns(columns, SYNONYMS))


def load_enterprises(spark: SparkSession, path: str) -> DataFrame:
    return load_multilingual(spark, path, "enterprises")


def load_establishments(spark: SparkSession, path: str) -> DataFrame:
    return load_multilingual(spark, path, "establishments")


def load_activities(spark: SparkSession, path: str) -> DataFrame:
    return load_multilingual(spark, path, "activities")
