from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from firmscout.functions.dates import parse_date
from firmscout.operators import filters, joins, lookups, mapping, rules
from firmscout.operators.dedupe import DEDUPE_KEY
from firmscout.operators.joins import ORDER
from firmscout.operators.keyfilter import LEAST_PLACES, MOST_PLACES, key_bits, may_hold, may_match, places_for
from firmscout.operators.seen import SeenKeys
from firmscout.plans import leads, snapshots
from firmscout.plans.params import LeadParams
from firmscout.sources import delimited, sink
from firmscout.sources.sink import export_run
from firmscout.sources.snapshot import load_snapshot, load_snapshots
from suite import bindings, queries

REGION = LeadParams(date(2026, 6, 1), postcodes=("9400",), min_score=0, limit=0)


def folder(tmp_path, tag, **tables):
    own = tmp_path / tag
    own.mkdir(parents=True)
    for name, lines in tables.items():
        (own / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(own)


def enterprises(*rows):
    return ["enterprise_number;name;status;start_date;postal_code", *rows]


EST = ["enterprise_number;establishment_number;address"]
ACT = ["enterprise_number;nace_code"]


@pytest.fixture
def two(spark, tmp_path):
    first = folder(
        tmp_path,
        "2026-01",
        enterprise=enterprises("1;Ash;AC;2026-01-02;9400", "2;Birch;AC;2026-01-02;9400", ";Blank;AC;2026-01-02;9400"),
        establishment=[*EST, "1;11;Old road", "2;12;Side road"],
        activity=[*ACT, "1;56.1", "1;47", "2;86"],
        contact=["EntityNumber;EntityContact;ContactType;Value", "11;EST;TEL;001", "2;ENT;EMAIL;b@x.test"],
    )
    second = folder(
        tmp_path,
        "2026-02",
        enterprise=enterprises("1;Ash tree;AC;2026-01-02;9400", "3;Cedar;AC;2026-01-02;9400"),
        establishment=[*EST, "1;11;New road"],
        activity=[*ACT, "1;86"],
    )
    return load_snapshots(spark, [second, first])


def short(df):
    columns = ["source_files_version", "enterprise_number", "name", "address", "nace_codes", "phone", "email"]
    return sorted(map(tuple, df.select(*columns).collect()))


def test_snapshots_in_one_run_do_not_meet(two):
    want = sorted(r for tag, one in two.items() for r in short(leads.build_leads(one, REGION)))
    assert len(want) == 4
    assert short(leads.build_leads(snapshots.combined(two), REGION)) == want
    run = leads.lead_run(snapshots.combined(two), REGION)
    assert short(run.leads) == want
    assert [(r["enterprise_number"], r["reject_reason"]) for r in run.rejected.collect()] == [("", "enterprise_number")]


def test_state_as_of_a_snapshot(two):
    now = short(leads.build_leads(snapshots.as_of(two), REGION))
    assert now == [
        ("2026-02", "1", "Ash tree", "New road", "86", "001", ""),
        ("2026-02", "2", "Birch", "Side road", "86", "", "b@x.test"),
        ("2026-02", "3", "Cedar", "", "", "", ""),
    ]
    assert short(leads.build_leads(snapshots.as_of(two, "2026-01"), REGION)) == short(leads.build_leads(two["2026-01"], REGION))


def test_wrong_snapshots(two, spark):
    one = two["2026-01"]
    for wrong in ({}, {"": one}, {"a|b": one}, {"~": one}):
        with pytest.raises(ValueError):
            snapshots.combined(wrong)
    with pytest.raises(ValueError, match="up to"):
        snapshots.as_of(two, "2025")
    with pytest.raises(ValueError, match="same tag"):
        load_snapshots(spark, [path_of(one), path_of(one)])


def path_of(registry):
    return registry.enterprise.select(f"{ORDER}.chunk.file").first()[0].rsplit("/", 1)[0]


# One run, two outputs


def test_a_run_computes_its_leads_once(spark, tmp_path):
    path = folder(
        tmp_path,
        "2026-01",
        enterprise=enterprises(*[f"{i};E{i};AC;2026-01-02;{'9400' if i % 3 else 'none'}" for i in range(1, 31)]),
        establishment=EST,
        activity=[*ACT, *[f"{i % 7};{56 + i}" for i in range(60)]],
    )
    registry, params = load_snapshot(spark, path), REGION.but(postcodes=())
    run = leads.lead_run(registry, params)
    for part in (run.leads, run.rejected):
        assert "Relation [" not in part._jdf.queryExecution().optimizedPlan().toString()
    assert short(run.leads) == short(leads.build_leads(registry, params)) and run.leads.count() == 20
    assert {r["reject_reason"] for r in run.rejected.collect()} == {"postal_code"} and run.rejected.count() == 10
    codes = {r["enterprise_number"]: r["nace_codes"] for r in run.rejected.collect()}
    assert codes["3"] == ",".join(str(56 + i) for i in range(60) if i % 7 == 3)
    few = leads.lead_run(registry, params.but(limit=5, on_invalid="drop"))
    assert few.leads.count() == 5 and few.rejected.count() == 0
    with pytest.raises(Exception, match="invalid postal_code"):
        leads.lead_run(registry, params.but(on_invalid="fail"))
    summary = export_run(run, str(tmp_path / "out"))
    assert (summary.written, summary.rejected) == (20, 10)


# Code lists below the join, narrowed by keys


def test_hot_code_list_is_built_in_pieces(spark):
    n, order = 30_000, F.struct(F.shiftright("id", 10).alias("chunk"), F.col("id"))
    key = F.when(F.col("id") % 3 == 0, "7").otherwise((F.col("id") % 5000 + 10).cast("string"))
    activity = spark.range(n).select(key.alias("enterprise_number"), F.col("id").cast("string").alias("nace_code"), order.alias(ORDER))
    found = spark.createDataFrame([("7", "", "a"), ("8", "", "b"), ("11", "", "c"), ("7", "", "d"), ("", "", "e")], "enterprise_number string, nace_codes string, name string")
    found = found.withColumn(ORDER, F.struct(F.lit(0).alias("chunk"), F.col("name")))
    registry = leads.Registry(found, found, activity=may_match(activity, found, "enterprise_number"))
    rows = {r["name"]: r["nace_codes"] for r in leads.with_codes(found, registry).collect()}
    hot = ",".join(str(i) for i in range(0, n, 3))
    assert rows["a"] == rows["d"] == hot and rows["b"] == rows["e"] == ""
    assert rows["c"] == ",".join(str(i) for i in range(n) if i % 3 and i % 5000 + 10 == 11)
    # No task of the step that gathers rows has more than a few chunks of the hot key.
    plan = lookups.activity_codes(activity)._jdf.queryExecution().executedPlan().toString()
    assert "chunk" in plan.split("ObjectHashAggregate")[-1]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        part = F.spark_partition_id().alias("part")
        pieces = activity.groupBy("enterprise_number", F.col(f"{ORDER}.chunk")).agg(F.count("*").alias("n")).where("enterprise_number = '7'")
        spread = [r["n"] for r in pieces.groupBy(part).agg(F.sum("n").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(spread) == n // 3 and max(spread) < n // 4


def test_key_filter_keeps_all_keys_and_few_others(spark):
    keys = spark.range(0, 40_000, 4).select(F.col("id").cast("string").alias("k"))
    keys = keys.unionByName(keys).unionByName(spark.createDataFrame([(None,)], "k string"))
    rows = spark.range(40_000).select("id", F.col("id").cast("string").alias("own"))
    passed = may_match(rows, keys, "k", on="own", places=1 << 18)
    assert passed.where("id % 4 = 0").count() == 10_000
    assert passed.count() < 10_000 + 0.06 * 30_000
    assert may_match(rows, keys.where("false"), "k", on="own").count() == 0
    both = rows.where(may_hold(key_bits(keys, "k", 1 << 20), F.col("own"), 1 << 20) & (F.col("id") < 100))
    assert {r["id"] for r in both.collect()} >= set(range(0, 100, 4))


def test_key_filter_starts_no_job_and_moves_no_row(spark):
    keys, rows = spark.range(10).selectExpr("cast(id AS string) AS k"), spark.range(1000).selectExpr("cast(id AS string) AS k")
    spark.sparkContext.setJobGroup("keyfilter", "keyfilter")
    try:
        cut = may_match(rows, keys, "k")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("keyfilter")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


# First rows of any number


@pytest.mark.parametrize("count", [1, 999, 1000, 1001, 25_000, 10**6])
def test_first_rows_without_an_ordered_limit(spark, count):
    rows = spark.range(30_000).repartition(5).select("id", F.struct(F.shiftright("id", 12).alias("chunk"), F.col("id").alias("row")).alias(ORDER))
    first = filters.first_rows(rows.where("id % 3 <> 0"), count, ordered=0)
    assert first.columns == rows.columns
    want = [i for i in range(30_000) if i % 3][:count]
    assert sorted(r["id"] for r in first.collect()) == want
    assert "Limit" not in first._jdf.queryExecution().optimizedPlan().toString()
    assert "Limit" in filters.first_rows(rows, 10)._jdf.queryExecution().optimizedPlan().toString()


def test_a_million_first_rows(spark):
    order = F.struct(F.shiftright("id", 16).alias("chunk"), F.col("id").alias("row")).alias(ORDER)
    first = filters.first_rows(spark.range(1_500_000).select("id", order), 1_000_000)
    assert first.agg(F.count("*"), F.max("id")).first()[:] == (1_000_000, 999_999)


# Rule tables


def test_longest_rule_decides(spark, table):
    codes = ["96.02", "96,021", "96.1", " 47 ", "4", None, "", "99", "47.1"]
    rows = table([{"nace_code": c} for c in codes], ["nace_code"])
    made = [("96", "person"), ("96.02", "beauty"), ("47", "b"), ("47", "a"), (None, "x"), ("", "all"), ("99", None), ("47.11", "deep")]
    out = rules.with_sector(rows, spark.createDataFrame(made, "prefix string, sector string"))
    got = [r["sector_bucket"] for r in out.orderBy(ORDER).collect()]
    assert got == ["beauty", "beauty", "person", "a", "other", "other", "other", "other", "a"]
    none = rules.with_sector(rows, spark.createDataFrame([], "prefix string, sector string"))
    assert {r["sector_bucket"] for r in none.collect()} == {"other"}


# The past of all runs


def test_seen_keys_grow_by_runs(spark, table, tmp_path):
    seen = SeenKeys(spark, str(tmp_path / "seen"))
    names = lambda *n: table([{"name": x, "address": "Road 1"} for x in n], ["name", "address"])
    assert seen.unseen(names("A", "B", "B")).count() == 3
    seen.add(names("A", "B", "B"), "one")
    assert [r["name"] for r in seen.unseen(names("a!", "C", None)).orderBy(ORDER).collect()] == ["C", None]
    seen.add(seen.unseen(names("a!", "C")), "two")
    seen.add(names("A"), "three")
    assert seen.unseen(names("A", "B", "C")).count() == 0
    nothing = table([{"name": None, "address": None}], ["name", "address"])
    seen.add(nothing, "four")
    assert seen.unseen(nothing).count() == 1
    assert seen.keys().groupBy(DEDUPE_KEY, "run").count().where("count > 1").count() == 0


# Tables narrowed to what eligible enterprises may have


def test_places_and_names_of_closed_enterprises_are_not_grouped(spark, table):
    enterprise = table(
        [{"enterprise_number": str(i), "status": "AC" if i % 10 == 0 else "IN", "start_date": "2026-01-01"} for i in range(300)],
        ["enterprise_number", "status", "start_date"],
    )
    places = [{"enterprise_number": str(i), "establishment_number": f"9{i}", "address": f"Road {i}"} for i in range(300)]
    establishment = table(places, ["enterprise_number", "establishment_number", "address", "postal_code", "city"])
    names = table([{"enterprise_number": str(i), "denomination": f"D{i}"} for i in range(300)], ["enterprise_number", "denomination"])
    registry = leads.Registry(enterprise, establishment, address=establishment, denomination=names)
    params = LeadParams(date(2026, 6, 1))
    cut = leads.narrowed_places(registry, params)
    for rows in (cut.establishment, cut.address, leads.narrowed(registry, params).denomination):
        kept = {int(r["enterprise_number"]) for r in rows.collect()}
        assert kept >= set(range(0, 300, 10)) and len(kept) < 60


@pytest.mark.parametrize("name, relation", [("dedupe_three_runs", "Relation [l_orderkey"), ("export_with_quarantine", "Relation [c_custkey")])
def test_staged_queries_read_their_tables_once(spark, monkeypatch, name, relation):
    """Several runs, or both outputs of one, from one reading: later frames are made from what the first one wrote."""
    plans = []

    def stage(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return joins.stage(df)

    monkeypatch.setattr(queries, "stage", stage)
    monkeypatch.setattr(sink, "stage", stage)
    queries.QUERIES[name](spark, "/root/testdata/sf0.001").count()
    assert sum(relation in plan for plan in plans) == 1


def test_a_date_mentions_its_text_once():
    assert str(parse_date(F.col("start_date"))).count("start_date") == 1


def test_identifiers_of_one_and_of_several_columns(spark, table):
    one = table([{"enterprise_number": v} for v in (" 0.12 ", None, "x", " 7")], ["enterprise_number"])
    assert [r["enterprise_number"] for r in mapping.map_activity(one).orderBy(ORDER).collect()] == ["012", "", "", "7"]
    columns = ["enterprise_number", "entity_number"]
    two = table([dict(zip(columns, v)) for v in ((" ", "1"), (None, "2"), ("x", "3"), ("4", None))], columns)
    assert [r["enterprise_number"] for r in mapping.map_activity(two).orderBy(ORDER).collect()] == ["1", "2", "", "4"]


# Runs over tables cut down first, and narrow sorts of what is written as text


def test_a_run_over_cut_down_tables_has_the_same_leads(spark, table):
    """Also a contact of an establishment whose last row names another enterprise than its first one."""
    enterprise = table(
        [{"enterprise_number": str(i), "status": "AC" if i % 10 == 0 else "IN", "start_date": "2026-01-01", "postal_code": "9400"} for i in range(300)],
        ["enterprise_number", "name", "status", "start_date", "postal_code", "city", "address", "website"],
    )
    places = [{"enterprise_number": str(i), "establishment_number": f"9{i}"} for i in range(300)]
    places += [{"enterprise_number": "1", "establishment_number": "910"}, {"enterprise_number": "20", "establishment_number": "921"}]
    establishment = table(places, ["enterprise_number", "establishment_number", "address", "postal_code", "city"])
    address = table([{"establishment_number": f"9{i}", "address": f"Road {i}", "city": "Ninove"} for i in range(300)], ["establishment_number", "address", "postal_code", "city"])
    contacts = [{"entity_number": f"9{i}", "entity_contact": "EST", "contact_type": "TEL", "value": f"tel {i}"} for i in range(300)]
    contacts += [{"entity_number": str(i), "contact_type": "EMAIL", "value": f"{i}@x"} for i in range(300)] + [{"value": "nobody's"}]
    contact = table(contacts, ["entity_number", "entity_contact", "contact_type", "value", "phone", "email", "website"])
    names = table([{"enterprise_number": str(i), "denomination": f"D{i}"} for i in range(300)], ["enterprise_number", "denomination", "type", "language"])
    codes = table([{"enterprise_number": str(i), "nace_code": f"96{i}"} for i in range(300)] * 2, ["enterprise_number", "nace_code"])
    registry = leads.Registry(enterprise, establishment, address, codes, contact, names, snapshot="t")
    params = LeadParams(date(2026, 6, 1), min_score=0, limit=0)
    cut = leads.cut_down(registry, params)
    expected = leads.build_leads(registry, params).collect()
    assert leads.build_leads(cut, params).collect() == expected and len(expected) == 30
    phones = {r["enterprise_number"]: r["phone"] for r in expected}
    assert phones["10"] == "" and phones["20"] == "tel 20"
    assert cut.enterprise.count() == 30
    for name in ("establishment", "address", "activity", "contact", "denomination"):
        assert getattr(cut, name).count() < getattr(registry, name).count() / 4, name
    lite = params.but(lite=True)
    assert leads.build_leads(leads.cut_down(registry, lite), lite).collect() == leads.build_leads(registry, lite).collect()


def test_a_filter_is_small_and_goes_alone_with_its_plans(spark, table):
    """A bit for every place; what its keys were found with is in no plan that tests it, nor is a second filter on the same keys."""
    keys = table([{"k": str(i)} for i in range(1000)], ["k"])
    words = spark.range(1).select(key_bits(keys, "k", 1 << 20).alias("w")).first()["w"]
    assert 64 * len(words) == 1 << 20 and 900 < sum(bin(w & (2**64 - 1)).count("1") for w in words) <= 1000
    enterprise = table([{"enterprise_number": str(i), "status": "AC", "start_date": "2026-01-01"} for i in range(9)], ["enterprise_number", "status", "start_date", "name", "postal_code", "city", "address", "website"])
    columns = ["enterprise_number", "establishment_number", "address", "postal_code", "city"]
    establishment = table([{"enterprise_number": str(i), "establishment_number": f"9{i}"} for i in range(9)], columns)
    address, codes = table([{"establishment_number": "91"}], columns[1:]), table([{"enterprise_number": "1", "nace_code": "96"}], ["enterprise_number", "nace_code"])
    params = LeadParams(date(2026, 6, 1))
    cut = leads.cut_down(leads.Registry(enterprise, establishment, address, codes), params)
    plan = cut.address._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("scalar-subquery") == 1 and "bit_or" not in plan and "start_date" not in plan
    assert leads.narrowed(cut, params).activity is cut.activity
    lists = leads.lead_rows(cut, params)._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" not in lists


def test_places_of_a_filter_follow_the_count():
    assert [places_for(n) for n in (0, 100_000, 400_000, 10**9)] == [LEAST_PLACES, 1 << 21, 1 << 23, MOST_PLACES]


@pytest.mark.parametrize("name", bindings.RAW_TABLES)
def test_rows_are_sorted_before_their_texts_are_built(spark, name):
    rows = bindings.raw(spark, "/root/testdata/sf0.001", name, in_order=True)
    assert [r[ORDER] for r in rows.collect()] == [r[ORDER] for r in rows.orderBy(ORDER).collect()]
    sorts = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Sort [" in line]
    assert len(sorts) == 1 and "_ord#" not in sorts[0]


def test_lines_are_not_sorted_by_their_file(spark):
    lines = spark.createDataFrame([("f", 0, "a;b", 1), ("f", 0, 'x;"y', 2)], "file string, block long, value string, place long")
    found = delimited._lines_by_file(lines)
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    assert [(r["line"], r["latin"], r["broken"]) for r in found.collect()] == [("a;b", False, True)]
