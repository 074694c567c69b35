from datetime import date

import pytest
from pyspark.sql import functions as F

from firmscout.operators import filters, profile, quality
from firmscout.plans.leads import LEAD_COLUMNS, all_leads, build_leads, flagged_enterprises, lead_rows, lead_run
from firmscout.plans.params import COMMAND_LINE, LeadParams
from firmscout.plans.region import region_leads, region_prefilter
from firmscout.sources.delimited import read_delimited
from firmscout.sources.sink import dry_run, export_leads, export_run
from firmscout.sources.snapshot import load_snapshot

AS_OF = date(2026, 6, 1)
REGION = LeadParams(AS_OF, postcodes=("9400",), min_score=0, limit=0)


def snapshot(tmp_path, **tables):
    folder = tmp_path / "2026-02-18"
    folder.mkdir()
    for name, lines in tables.items():
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(tmp_path)


def leads(spark, path, params=REGION, **options):
    return [r.asDict() for r in build_leads(load_snapshot(spark, path, lite=params.lite, **options), params).collect()]


FULL = {
    "enterprise": ["EnterpriseNumber;Status;StartDate", "0711.402.935;AC;17/03/2026"],
    "establishments": ["EnterpriseNumber;EstablishmentNumber", "0711.402.935;2.884.016.527"],
    "address": [
        "EntityNumber;Zipcode;MunicipalityNL;MunicipalityFR;StreetNL;StreetFR;HouseNumber;Box",
        "2.884.016.527;9400 Kersdorp;Kersdorp;Cerisy;Vlierpad;Sentier du Sureau;31;2a",
    ],
    "activities": ["EnterpriseNumber;NaceCode", "0711.402.935;96.021", "0711.402.935;47762"],
    "contact": [
        "EntityNumber;EntityContact;ContactType;Value",
        '"2.884.016.527";VESTIGING;EMAIL;salon@vlierpad.test',
        '"0555.010.203";ENT;WEB;www.nobody.test',
        '"2.884.016.527";EST;FAX;053 00 00 01',
        '"2.884.016.527";EST;TEL;053 77 61 40',
    ],
    "denomination": [
        "EntityNumber;Denomination;TypeOfDenomination;Language",
        "0711.402.935;Sign on the door;003;FR",
        "0711.402.935;Vlier Hair;001;DE",
    ],
}
LEAD = {
    "enterprise_number": "0711402935",
    "name": "Vlier Hair",
    "status": "ACTIVE",
    "start_date": "17/03/2026",
    "address": "Vlierpad 31 box 2a",
    "postal_code": "9400",
    "city": "Kersdorp",
    "nace_codes": "96.021,47762",
    "sector_bucket": "beauty",
    "has_website": "no",
    "website": "",
    "phone": "053 77 61 40",
    "email": "salon@vlierpad.test",
    "score_total": 53,
    "score_reasons": "new<18m|sector_high|has_phone|has_email",
    "source_files_version": "2026-02-18",
}


@pytest.mark.parametrize("build", [build_leads, region_leads])
def test_full_lead(spark, tmp_path, build):
    registry = load_snapshot(spark, snapshot(tmp_path, **FULL))
    out = build(registry, REGION)
    assert out.columns == LEAD_COLUMNS
    assert [r.asDict() for r in out.collect()] == [LEAD]


def test_lite_needs_no_activities(spark, tmp_path):
    tables = {k: v for k, v in FULL.items() if k != "activities"}
    path = snapshot(tmp_path, **tables)
    with pytest.raises(FileNotFoundError, match="activities.csv"):
        load_snapshot(spark, path)
    lite = REGION.but(lite=True, min_score=40)
    assert leads(spark, path, lite) == [
        {**LEAD, "nace_codes": "", "sector_bucket": "", "score_total": 0, "score_reasons": "lite_mode|has_phone|has_email"}
    ]


MANY = {
    "enterprises": [
        "enterprise_number,name,status,start_date,address,postal_code,city,website",
        "31,Quill,ACTIVE,1998-11-05,Inkwell 4,9400,Kersdorp,",
        "32,Ferry,ac,2026-02-03,Quay 9,9500,Oversea,",
        "33,Slate, AC ,2026-02-03,Roof 12,B-9400,Kersdorp,https://slate.test",
        "34,Ember,IN,2026-02-03,Hearth 1,9400,Kersdorp,",
        "35,Drift,AC,,Shore 8,9400,Kersdorp,",
        "36,Mumble,AC,someday,Fog 2,9400,Kersdorp,",
        "37,Comb,AC,2097-08-09,Own yard 3,,,",
        "33,Slate II,AC,2026-02-03,Roof 14,9400,Kersdorp,",
        ",Blank,AC,2026-02-03,Nowhere 5,9400,Kersdorp,",
    ],
    "establishment": [
        "enterprise_number,address,postal_code,city",
        "37,Attic 6,,",
        "37,Cellar 7,9400 Kersdorp,Kersdorp",
        "37,Garden 8,9400,Kersdorp",
    ],
    "activity": ["enterprise_number,nace_code", "37,96.02", "33,01"],
    "contacts": ["enterprise_number,phone,email", "33,0470 33,", "33,0470 34,roof@slate.test"],
}


def test_filters_order_and_duplicates(spark, tmp_path):
    path = snapshot(tmp_path, **MANY)
    out = leads(spark, path)
    assert [(r["name"], r["score_total"]) for r in out] == [("Comb", 45), ("Slate", 38), ("Slate II", 38)]
    assert (out[0]["address"], out[0]["postal_code"], out[0]["phone"]) == ("Cellar 7", "9400", "")
    assert (out[1]["phone"], out[1]["email"], out[1]["has_website"]) == ("0470 33", "roof@slate.test", "yes")
    # The limit takes the first qualifying rows in file order, before the sort.
    assert [r["name"] for r in leads(spark, path, REGION.but(limit=2))] == ["Comb", "Slate"]
    assert [r["name"] for r in leads(spark, path, REGION.but(limit=1))] == ["Slate"]
    assert [r["name"] for r in leads(spark, path, REGION.but(min_score=40))] == ["Comb"]
    assert [r["name"] for r in leads(spark, path, REGION.but(query="SLATE ii"))] == ["Slate II"]
    assert [r["name"] for r in leads(spark, path, REGION.but(query="beauty", city="kers"))] == ["Comb"]
    assert [r["name"] for r in leads(spark, path, REGION.but(postcodes=(), city="sea"))] == ["Ferry"]


def test_nothing_is_cut_off_unless_asked_for(spark, tmp_path):
    path = snapshot(tmp_path, **MANY)
    assert len(leads(spark, path, LeadParams(AS_OF, postcodes=("9400",)))) == 3
    command_line = LeadParams(AS_OF, postcodes=("9400",), **COMMAND_LINE)
    assert (command_line.limit, command_line.min_score) == (200, 40)
    assert [r["name"] for r in leads(spark, path, command_line)] == ["Comb"]


def test_many_leads_with_a_limit(spark):
    rows = spark.range(120_000).select(F.struct(F.shiftright("id", 10).alias("chunk"), "id").alias("_ord"), "id").repartition(7)
    cut = filters.first_rows(rows, 100_000)
    assert cut.agg(F.count("*"), F.max("id")).first() == (100_000, 99_999)


def test_validity(spark, tmp_path):
    registry = load_snapshot(spark, snapshot(tmp_path, **MANY))
    every = all_leads(registry, REGION)
    assert [r["reject_reason"] for r in quality.rejected_leads(every).collect()] == ["enterprise_number"]
    assert quality.valid_leads(every).count() == 3
    with pytest.raises(Exception, match="invalid enterprise_number"):
        build_leads(registry, REGION.but(on_invalid="fail")).collect()
    assert quality.require_valid(quality.valid_leads(every)).count() == 3
    usable = filters.usable(lead_rows(registry, REGION))
    assert {r["name"] for r in usable.collect()} == {"Slate", "Slate II"}


def test_rejected_rows_are_returned_and_written(spark, tmp_path):
    registry = load_snapshot(spark, snapshot(tmp_path, **MANY))
    run = lead_run(registry, REGION)
    summary = export_run(run, str(tmp_path / "out" / "leads"))
    assert (summary.written, summary.rejected) == (3, 1)
    back = read_delimited(spark, str(tmp_path / "out" / "leads-rejected")).collect()
    assert [(r["name"], r["reject_reason"]) for r in back] == [("Blank", "enterprise_number")]
    assert lead_run(registry, REGION.but(on_invalid="drop")).rejected.count() == 0
    with pytest.raises(Exception, match="invalid enterprise_number"):
        lead_run(registry, REGION.but(on_invalid="fail")).leads.collect()


def test_reports(spark, tmp_path):
    registry = load_snapshot(spark, snapshot(tmp_path, **MANY))
    flagged = flagged_enterprises(registry, REGION)
    assert profile.stage_funnel(flagged).head().asDict() == {
        "loaded": 9, "active": 8, "with_establishment": 1, "with_contact": 2, "after_postcode": 6,
    }
    coverage = profile.join_coverage(flagged).head()
    assert (coverage["with_establishment"], coverage["with_contact"]) == (1, 2)
    assert coverage["contact_percent"] == pytest.approx(200 / 9)
    empty = profile.join_coverage(flagged.where("false")).head()
    assert (empty["enterprises"], empty["contact_percent"]) == (0, None)
    found = lead_rows(registry, REGION)
    assert tuple(profile.result_profile(found).head()) == (3, 2, date(2026, 2, 3), date(2097, 8, 9))
    assert [r[0] for r in profile.result_ids(found).collect()] == ["33", "37"]


def test_export(spark, tmp_path):
    registry = load_snapshot(spark, snapshot(tmp_path, **MANY))
    found = lead_rows(registry, REGION)
    path = tmp_path / "out" / "leads.csv"
    summary = export_leads(found, str(path), single_file=True)
    assert summary.written == dry_run(found) == 3
    assert [tuple(r) for r in summary.sectors.collect()] == [("other", 2), ("beauty", 1)]
    part = next(path.glob("part-*.csv")).read_text(encoding="utf-8").splitlines()
    assert part[0] == ",".join(LEAD_COLUMNS)
    assert part[1].startswith("37,Comb,ACTIVE,2097-08-09,Cellar 7,9400,Kersdorp,96.02,beauty,no,,,,45,")
    assert len(part) == 4


def test_region_first_is_narrower_than_the_normal_run(spark, tmp_path):
    tables = {
        "enterprises": ["enterprise_number;name;status;start_date;postal_code"]
        + [f"{i};E{i};AC;2026-01-01;{'9400' if i == 2 else ''}" for i in (1, 2, 3)],
        "establishments": ["enterprise_number;establishment_number;postal_code", "1;11;", "1;12;9500", "3;13;9400"],
        "addresses": ["establishment_number;zipcode;street", "11;9400;Main", "13;1000;Side"],
        "activities": ["enterprise_number;nace_code", "1;56", "2;86"],
    }
    registry = load_snapshot(spark, snapshot(tmp_path, **tables))
    assert [r["name"] for r in build_leads(registry, REGION).orderBy("name").collect()] == ["E1", "E2", "E3"]
    assert [r["name"] for r in region_leads(registry, REGION).collect()] == ["E1"]
    cut = region_prefilter(registry, ("9400",))
    assert cut.sizes() == (1, 1)
    assert cut.registry.activity.count() == 1
    assert region_prefilter(registry, ("1234",)).registry.enterprise.count() == 0
    assert region_leads(registry, REGION.but(postcodes=())).count() == build_leads(registry, REGION.but(postcodes=())).count()


@pytest.mark.parametrize("build", [build_leads, region_leads])
def test_shuffled_and_skewed_paths_give_the_same_leads(spark, tmp_path, build):
    """No broadcast by size; converted tables; repeated keys on all sides."""
    tables = {
        "enterprises": ["enterprise_number;name;status;start_date"]
        + [f"{i % 4 if i % 5 else ''};E{i};AC;2026-01-{1 + i:02};" for i in range(28)],
        "establishments": ["enterprise_number;establishment_number"] + [f"{i % 5};{i % 7}" for i in range(40)],
        "addresses": ["establishment_number;zipcode;street"] + [f"{i % 7};{9400 + i % 3};S{i}" for i in range(50)],
        "activities": ["enterprise_number;nace_code"] + [f"{i % 5};{(56, 86, 47)[i % 3]}.{i}" for i in range(60)],
        "contacts": ["EntityNumber;EntityContact;ContactType;Value"]
        + [f"{i % 6};{('EST', 'ENT')[i % 2]};{('TEL', 'EMAIL', 'WEB', 'FAX')[i % 4]};v{i}" for i in range(60)],
        "denominations": ["EntityNumber;Denomination;TypeOfDenomination;Language"]
        + [f"{i % 6};D{i};00{1 + i % 3};{('FR', 'NL')[i % 2]}" for i in range(40)],
    }
    registry = load_snapshot(spark, snapshot(tmp_path, **tables))
    want = [r.asDict() for r in build(registry, REGION).collect()]
    assert len(want) > 5 and len({r["enterprise_number"] for r in want}) < len(want)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert [r.asDict() for r in build(registry, REGION).collect()] == want
        again = load_snapshot(spark, str(tmp_path), work_dir=str(tmp_path.parent / f"{tmp_path.name}-work"))
        assert [r.asDict() for r in build(again, REGION).collect()] == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
