import pytest

import __spark_entry__ as entry_point
import check

SMALL = "/root/testdata/sf0.001"
# A cross-section; check.py compares all of them.
NAMES = [
    "leads_flagship",
    "leads_region_first",
    "map_contact",
    "establishment_filled",
    "contacts_resolved",
    "activity_codes",
    "denomination_best",
    "postcode_top10",
    "dedupe_in_run",
    "csv_roundtrip",
]


def test_every_query_has_sql():
    assert set(entry_point.QUERIES) == set(entry_point.ORACLE)
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    types, found = check.spark_rows(entry_point.queries()[name](spark, SMALL))
    want_types, want = check.oracle_rows(check.database(SMALL), entry_point.oracle_sql()[name])
    assert types == want_types
    assert found == want


def test_entry(spark):
    assert entry_point.entry(spark).count() == 13
