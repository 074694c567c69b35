import pytest
from pyspark.sql import functions as F

from firmscout.sources.delimited import file_shapes, find_delimiter, read_delimited, read_strict
from firmscout.sources.files import Folder, path_by_stem, snapshot_folder, table_path
from firmscout.sources.headers import canonical_columns, canonical_name, detect_columns, first_present, plain_name
from firmscout.sources.providers import Provider, Providers
from firmscout.sources.snapshot import SYNONYMS, load_activities, load_enterprises


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def rows(df):
    """Rows in file order without the order column."""
    columns = [c for c in df.columns if c != "_ord"]
    return [tuple(r) for r in df.orderBy("_ord").select(*columns).collect()]


def test_header_names():
    assert [canonical_name(h) for h in ["Zipcode", "MunicipalityNL", "MunicipalityFR", "StreetNL", "HouseNumber"]] == [
        "postal_code", "city", "city_fr", "street", "house_number",
    ]
    assert plain_name("  Numéro d'entreprise (KB) ") == "numero_d_entreprise_kb"
    assert detect_columns(["zip", "postal_code", "ville", "nr"], SYNONYMS) == {
        "postal_code": "postal_code", "ville": "city", "nr": "number",
    }


def test_last_of_equal_columns_stays(table):
    df = canonical_columns(table([{"Zipcode": "1", "postal_code": "2", "Postal Code": "3"}], ["Zipcode", "postal_code", "Postal Code"]))
    assert df.columns == ["postal_code", "_ord"] and df.head()["postal_code"] == "3"
    assert first_present(df.columns, ["x", "postal_code"]) == "postal_code" and first_present(df.columns, ["x"]) is None


@pytest.mark.parametrize(("line", "delimiter"), [("a;b,c;d", ";"), ("a,b", ","), ("a\tb", "\t"), ("a", ";"), ('"a;b",c', ",")])
def test_delimiter(line, delimiter):
    assert find_delimiter(line) == delimiter


@pytest.mark.parametrize(
    ("text", "encoding", "want"),
    [
        ("id,name\n1,Acme\n", "utf-8", [("1", "Acme")]),
        ("id;name\n1;café\n\n2;x\n", "latin-1", [("1", "café"), ("2", "x")]),
        ("id;name\n1;café �\n", "utf-8-sig", [("1", "café �")]),
        ('id;name\n1;"a ""b""; c"\n2;"two\nlines"\n3;x', "utf-8", [("1", 'a "b"; c'), ("2", "two\nlines"), ("3", "x")]),
        ("id;name\n1\n2;b;extra\n3; c \n", "utf-8", [("1", None), ("2", "b"), ("3", " c ")]),
        ("Zip;zip;name\n1;2;3\n", "utf-8", [("2", "3")]),
    ],
)
def test_reading(spark, tmp_path, text, encoding, want):
    assert rows(read_delimited(spark, write(tmp_path / "t.csv", text, encoding))) == want


def test_header_of_latin1_file_and_repeated_names(spark, tmp_path):
    path = write(tmp_path / "t.csv", "numéro;a;a\n1;x;y\n", "latin-1")
    df = read_delimited(spark, path)
    assert df.columns == ["numéro", "a", "_ord"] and rows(df) == [("1", "y")]


def test_part_files_are_read_each_in_its_own_way(spark, tmp_path):
    write(tmp_path / "t.csv" / "p0.csv", "id;name\n1;é\n", "latin-1")
    write(tmp_path / "t.csv" / "p1.csv", 'id;name\n2;"x\ny"\n')
    write(tmp_path / "t.csv" / "p2.csv", "id;name\n3;é\n")
    assert rows(read_delimited(spark, str(tmp_path / "t.csv"))) == [("1", "é"), ("2", "x\ny"), ("3", "é")]


def test_file_order_over_many_splits(spark, tmp_path):
    path = write(tmp_path / "t.csv", "id;pad\n" + "".join(f"{i};{'x' * 50}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16KB")
    try:
        df = read_delimited(spark, path)
        assert df.rdd.getNumPartitions() > 4
        shuffled = df.repartition(5, F.xxhash64("id"))
        assert [r[0] for r in rows(shuffled.select("id", "_ord"))] == [str(i) for i in range(3000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_with_other_headers(spark, tmp_path):
    write(tmp_path / "t.csv" / "p0.csv", "id;name\n1;wren\n")
    write(tmp_path / "t.csv" / "p1.csv", "name,id,age\nheron,2,7\n")
    write(tmp_path / "t.csv" / "p2.csv", "")
    found = {(r["id"], r["name"], r["age"]) for r in read_delimited(spark, str(tmp_path / "t.csv")).collect()}
    assert found == {("1", "wren", None), ("2", "heron", "7")}
    named = read_delimited(spark, str(tmp_path / "t.csv"), encoding="UTF-8", multiline=False)
    assert {(r["id"], r["name"]) for r in named.collect()} == {("1", "wren"), ("2", "heron")}


def test_empty_tables(spark, tmp_path):
    path = write(tmp_path / "t.csv", "")
    with pytest.raises(ValueError, match="no header line"):
        read_delimited(spark, path)
    empty = read_delimited(spark, path, may_be_empty=True)
    assert empty.columns == ["_ord"] and empty.count() == 0


@pytest.mark.parametrize(
    ("line", "multiline"),
    [('1;5" pipe', False), ('1;"a"', False), ('1;"a', True), ('"1;a', True), ('1;a"', False), ('1;"a ""b"""', False)],
)
def test_only_a_quote_at_the_start_of_a_field_opens_one(spark, tmp_path, line, multiline):
    path = write(tmp_path / "t.csv", f"id;name\n{line}\n")
    assert [s.multiline for s in file_shapes(spark, path)] == [multiline]


def test_source_headers_may_begin_with_an_underscore(table):
    df = table([{"_Name": "a", "_ID": "b"}], ["_Name", "_ID"])
    assert canonical_columns(df).columns == ["name", "id", "_ord"]


def test_strict_reading(spark, tmp_path):
    path = write(tmp_path / "t.csv", "id,name\n10,Wren\n20,Torn,surplus\n30,Heron\n40\n")
    good, bad = read_strict(spark, path, max_bad_rows=2)
    assert rows(good) == [("10", "Wren"), ("30", "Heron")]
    assert [r[0] for r in rows(good.select("id", "_ord"))] == ["10", "30"]
    assert [r["_corrupt_record"] for r in bad.orderBy("_ord").collect()] == ["20,Torn,surplus", "40"]
    with pytest.raises(RuntimeError, match="more than 1 malformed"):
        read_strict(spark, path, max_bad_rows=1)
    with pytest.raises(ValueError):
        read_strict(spark, path, max_bad_rows=-1)


def test_snapshot_folder(spark, tmp_path):
    write(tmp_path / "a" / "2026-02-18" / "enterprise.csv", "x\n")
    assert snapshot_folder(spark, str(tmp_path / "a")).path.endswith("a/2026-02-18")
    write(tmp_path / "a" / "other" / "enterprise.csv", "x\n")
    assert snapshot_folder(spark, str(tmp_path / "a")).path.endswith("/a")
    write(tmp_path / "b" / "t.CSV", "x\n")
    write(tmp_path / "b" / "sub" / "t.csv", "x\n")
    assert snapshot_folder(spark, str(tmp_path / "b")).path.endswith("/b")


def test_table_path(spark, tmp_path):
    names = ["enterprises.csv", "enterprise.csv"]
    write(tmp_path / "unexpected.csv", "x\n")
    with pytest.raises(FileNotFoundError, match="enterprises.csv, enterprise.csv, found unexpected.csv"):
        table_path(Folder(spark, str(tmp_path)), names)
    for name in ["enterprise.csv.csv", "enterprise.csv", "enterprises.csv"]:
        write(tmp_path / name, "x\n")
        assert table_path(Folder(spark, str(tmp_path)), names).endswith("/" + name)


def test_multilingual_tables(spark, tmp_path):
    write(tmp_path / "Lijst_ondernemingen.csv", "Ondernemingsnummer;Statuut;Code postal;Ville\n0123.4;AC;NA;\n")
    write(tmp_path / "nacebel.csv", "company number;NACE\n1;96.02\n")
    df = load_enterprises(spark, str(tmp_path))
    assert df.columns == ["enterprise_number", "status", "postal_code", "city", "_ord"]
    assert rows(df) == [("0123.4", "AC", None, None)]
    assert rows(load_activities(spark, str(tmp_path / "nacebel.csv"))) == [("1", "96.02")]
    with pytest.raises(FileNotFoundError):
        path_by_stem(spark, str(tmp_path), "establishments")
    with pytest.raises(FileNotFoundError):
        load_enterprises(spark, str(tmp_path / "missing"))


def test_providers(spark, table):
    raw = table([{"id": " 1 ", "name": "Bakery"}, {"id": "2", "name": "Bank"}], ["id", "name"])
    provider = Provider("xx", load=lambda spark, path: raw)
    found = provider.records(spark, "")
    assert found.columns == [
        "enterprise_number", "name", "address", "postal_code", "city", "phone", "email", "website",
        "source_files_version", "_ord",
    ]
    assert rows(found)[0] == ("1", "Bakery", "", "", "", "", "", "", "provider-template")
    assert [r["name"] for r in provider.search(spark, "", "ba", 1).collect()] == ["Bakery"]
    assert Providers(provider).of(" XX") is provider
    with pytest.raises(ValueError, match="supported: XX"):
        Providers(provider).of("NL")
