from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from firmscout.functions import scores, sectors, text
from firmscout.functions.dates import age_months, first_young_day, parse_date
from firmscout.operators.gaps import by_gap_score, score_gaps
from firmscout.plans.params import DEFAULT_POSTCODES, LeadParams, parse_postcodes


def values(spark, function, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v")).alias("x")).collect()]


def test_cleaned_strips_all_white_space(spark):
    df = spark.createDataFrame([(" \t a b 　",), ("  ",), (None,)], "v string")
    assert [r.v for r in text.cleaned(df, ["v"]).collect()] == ["a b", None, None]


def test_cleaned_looks_at_both_ends_of_every_text(spark):
    ends = ["", "a", "~", "!", "é", "\x7f", "\x01", " ", "\t", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "\U0001f600"]
    given = [a + b + c for a in ends for b in ("", "x", " y ") for c in ends]
    df = spark.createDataFrame(list(enumerate(given)), "i int, v string")
    got = [r.v for r in text.cleaned(df, ["v"]).orderBy("i").collect()]
    assert got == [v.strip(text.WHITESPACE) or None for v in given]
    numbers = spark.range(2).select(F.col("id").alias("v"))
    assert [r.v for r in text.cleaned(numbers, ["v"]).orderBy("v").collect()] == ["0", "1"]


def test_digits(spark):
    assert values(spark, text.digits, ["0123.456.789", '"2.111"', "x", None]) == ["0123456789", "2111", "", ""]


def test_postal_code(spark):
    given = ["9400", "9400 Ninove", "B-9400", "x94001y 9500", "94001", "é9400", "Ninove", None]
    assert values(spark, text.postal_code, given) == [
        "9400", "9400", "9400", "9500", "94001", "é9400", "Ninove", None,
    ]


def test_status(spark):
    assert values(spark, text.status_label, ["AC", "ac", "IN", "Stopped", None]) == [
        "ACTIVE", "ACTIVE", "INACTIVE", "Stopped", None,
    ]
    assert values(spark, text.is_active, ["AC", "active", "IN", "", None]) == [True, True, False, False, False]


def test_dates(spark):
    given = ["1960-08-09", "09-08-1960", "9/8/1960", "2001-2-3"]
    assert values(spark, parse_date, given) == [date(1960, 8, 9)] * 3 + [date(2001, 2, 3)]
    none = ["0", "0000-00-00", "00-00-0000", "0000/00/00", "not-a-date", "2001-02-30", "2001-01-01x", None]
    assert values(spark, parse_date, none) == [None] * len(none)


def test_age_ignores_days_and_may_be_negative(spark):
    age = lambda v: age_months(parse_date(v), date(2001, 8, 1))
    assert values(spark, age, ["2000-02-29", "2001-08-31", "2002-01-01", "x"]) == [18, 0, -5, None]


@pytest.mark.parametrize(("as_of", "months"), [(date(2001, 8, 1), 18), (date(2024, 1, 31), 1), (date(2024, 12, 5), 12)])
def test_first_young_day_is_the_age_limit(as_of, months):
    first = first_young_day(as_of, months)
    assert (as_of.year * 12 + as_of.month) - (first.year * 12 + first.month) == months
    assert first.day == 1


def test_sectors(spark):
    given = ["96.02", "96,02", "96021", "56101", "86210", "47240", "43210", "81", "95", "01", "", None]
    assert values(spark, sectors.sector_of, given) == [
        "beauty", "beauty", "other", "horeca", "health", "retail", "service_trades", "service_trades",
        "service_trades", "other", "other", "other",
    ]
    assert values(spark, sectors.allowed_sector, [" Beauty ", "bank", None]) == ["beauty", "other", "other"]


@pytest.mark.parametrize(
    ("age", "sector", "code", "phone", "email", "website", "score", "reasons"),
    [
        (3, "other", "1", None, None, None, 30, "new<18m"),
        (3, "other", None, None, None, None, 25, "new<18m|no_nace"),
        (3, "other", "1", "p", "e", "w", 38, "new<18m|has_phone|has_email|has_website"),
        (3, "other", "1", None, None, "w", 30, "new<18m|has_website"),
        (3, "beauty", "96.02", "p", "e", None, 53, "new<18m|sector_high|has_phone|has_email"),
        (99, "other", None, None, None, None, 0, "no_nace"),
        (None, "health", "86", None, None, None, 15, "sector_high"),
    ],
)
def test_lead_score(spark, age, sector, code, phone, email, website, score, reasons):
    schema = "age int, sector string, code string, phone string, email string, website string"
    df = spark.createDataFrame([(age, sector, code, phone, email, website)], schema)
    c = [F.col(n) for n in df.columns]
    rules = scores.lead_rules(c[0], 18, *c[1:])
    assert tuple(df.select(scores.lead_score(rules), scores.reasons(rules)).head()) == (score, reasons)


def test_gap_scores(table):
    rows = [
        {"start_date": "2001-07-01", "nace": "96.02", "phone": "p", "email": ""},
        {"start_date": "2000-02-01", "nace": "", "phone": None, "email": "e"},
        {"start_date": "2000-01-31", "nace": "01", "phone": "p", "email": "e"},
    ]
    df = table(rows, ["start_date", "nace", "phone", "email"])
    out = by_gap_score(score_gaps(df, datetime(2001, 8, 1), 18)).select("sector", "score_total", "score_reasons")
    assert [tuple(r) for r in out.collect()] == [
        ("beauty", 50, "new<18m;+30|sector;+15|missing_email;+5"),
        ("other", 30, "new<18m;+30|missing_phone;+5|missing_nace;-5"),
        ("other", 0, ""),
    ]
    later = score_gaps(df, datetime(2001, 8, 1, 0, 0, 1), 18).orderBy("_ord").select("score_total")
    assert [r[0] for r in later.collect()] == [50, 0, 0]
    bare = score_gaps(df.select("_ord").withColumn("sector", F.lit(" Retail ")), datetime(2001, 8, 1))
    assert {tuple(r) for r in bare.select("sector", "score_total", "score_reasons").collect()} == {("retail", 0, "")}


def test_params():
    assert parse_postcodes("9400, 9500 Geraardsbergen,9400,,x1") == ("9400", "9500", "x1")
    assert parse_postcodes(" , ") == DEFAULT_POSTCODES
    assert LeadParams(date(2001, 1, 1), lite=True).score_floor == 0
    for bad in [{"months": 0}, {"limit": -1}, {"min_score": 101}, {"country": "NL"}, {"on_invalid": "x"}]:
        with pytest.raises(ValueError):
            LeadParams(date(2001, 1, 1), **bad)
