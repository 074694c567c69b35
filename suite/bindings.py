"""The given Parquet tables as raw registry tables (see FIXTURES.md, part B).

No row is left out: where the registry would lack a record, its key or value is
blank, and the operators under test have to cope.
"""

from __future__ import annotations

from datetime import date
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmscout.operators.joins import ORDER
from firmscout.plans.leads import Registry
from firmscout.plans.params import LeadParams
from firmscout.sources.headers import canonical_columns
from firmscout.sources.snapshot import registry_of

AS_OF = date(2001, 8, 1)
REGION = tuple(str(9400 + i) for i in range(13))
EARLIER_REGION = REGION[:6]
SNAPSHOT = "driver-tables"

CODE_HEADS = ["96", "56", "86", "47", "43", "81", "95", "01"]
CODE_TAILS = [".02", "021", ""]
STATUSES = ["AC", "ACTIVE", " ac ", "IN", "Stopped"]
LANGUAGES = ["NL", "fr", "EN", "D", ""]


def params(**changes) -> LeadParams:
    """Parameters of the suite: everything in the region, whatever its score."""
    return LeadParams(as_of=AS_OF, postcodes=REGION, min_score=0, limit=0).but(**changes)


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; kept, as every read of a Parquet path looks up its schema anew."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dotted(prefix: str, number: Column) -> Column:
    padded = F.lpad(number.cast("string"), 9, "0")
    groups = [F.substring(padded, start, 3) for start in (1, 4, 7)]
    return F.concat(F.lit(prefix), F.concat_ws(".", *groups))


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def blank_if(condition: Column, value: Column) -> Column:
    return F.when(condition, F.lit("")).otherwise(value)


def ordered(df: DataFrame, first: str, *rest: str, bits: int = 16) -> Column:
    """``_ord`` from the unique key of the source table; a chunk is a run of its first column."""
    return F.struct(F.shiftright(F.col(first), bits).alias("chunk"), F.col(first), *rest).alias(ORDER)


def sorted_if(in_order: bool, df: DataFrame, *keys: str) -> DataFrame:
    """Rows in the order of ``_ord`` if asked for: sorted by the narrow keys it is made from, before texts are built."""
    return df.orderBy(*keys) if in_order else df


def raw_enterprise(spark: SparkSession, sf_dir: str, in_order: bool = False) -> DataFrame:
    key = F.col("c_custkey")
    start = F.col("o_orderdate")
    iso = F.date_format(start, "yyyy-MM-dd")
    spellings = {
        1: F.date_format(start, "dd-MM-yyyy"),
        2: F.date_format(start, "dd/MM/yyyy"),
        3: F.lit(""),
        4: F.lit("0000-00-00"),
        5: F.lit("not-a-date"),
    }
    start_date = reduce(lambda other, kv: F.when(key % 7 == kv[0], kv[1]).otherwise(other), spellings.items(), iso)
    code = (F.col("c_nationkey") + 9400).cast("string")
    post_code = (
        F.when(key % 4 == 0, F.lit(""))
        .when(key % 4 == 1, code)
        .when(key % 4 == 2, F.concat_ws(" ", code, F.col("n_name")))
        .otherwise(F.concat(F.lit("B-"), code))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    nation = table(spark, sf_dir, "nation")
    joined = table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_orderkey"))
    joined = joined.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    joined = sorted_if(in_order, joined, "c_custkey")
    return joined.select(
        dotted("0", key).alias("EnterpriseNumber"),
        blank_if(key % 3 == 0, F.col("c_name")).alias("Denomination"),
        pick(STATUSES, key).alias("Status"),
        start_date.alias("StartDate"),
        post_code.alias("PostCode"),
        blank_if(key % 6 == 0, F.col("n_name")).alias("city"),
        F.when(key % 8 == 0, F.concat(F.lit("https://c"), key, F.lit(".example"))).otherwise("").alias("website"),
        ordered(joined, "c_custkey"),
    )


def raw_establishment(spark: SparkSession, sf_dir: str, in_order: bool = False) -> DataFrame:
    key, owner = F.col("o_orderkey"), F.col("o_custkey")
    orders = sorted_if(in_order, table(spark, sf_dir, "orders"), "o_orderkey")
    return orders.select(
        blank_if(owner % 11 == 4, dotted("0", owner)).alias("EnterpriseNumber"),
        dotted("2.", key).alias("EstablishmentNumber"),
        blank_if(key % 3 == 0, (key % 25 + 9400).cast("string")).alias("PostCode"),
        blank_if(key % 2 == 0, F.col("o_orderpriority")).alias("StreetNL"),
        ordered(orders, "o_orderkey"),
    )


LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


def line_order(df: DataFrame) -> Column:
    return ordered(df, *LINE_KEYS)


def raw_address(spark: SparkSession, sf_dir: str, in_order: bool = False) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    places = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    lines = table(spark, sf_dir, "lineitem").join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    lines = sorted_if(in_order, lines, *LINE_KEYS)
    code = (F.col("s_nationkey") + 9400).cast("string")
    return lines.select(
        blank_if(F.col("l_orderkey") % 4 == 0, dotted("2.", F.col("l_orderkey"))).alias("EntityNumber"),
        F.concat_ws(" ", code, F.col("n_name")).alias("Zipcode"),
        F.col("n_name").alias("MunicipalityNL"),
        F.col("s_name").alias("StreetNL"),
        F.col("l_linenumber").cast("string").alias("HouseNumber"),
        F.when(F.col("l_partkey") % 4 == 0, F.lit("A")).otherwise("").alias("Box"),
        line_order(lines),
    )


def owned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the owner of their order; the text of its number is built once per order."""
    owner = dotted("0", F.col("o_custkey")).alias("owner")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", owner)
    return table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def raw_activity(spark: SparkSession, sf_dir: str, in_order: bool = False) -> DataFrame:
    lines = sorted_if(in_order, owned_lines(spark, sf_dir), *LINE_KEYS)
    code = F.concat(pick(CODE_HEADS, F.col("l_partkey")), pick(CODE_TAILS, F.col("l_suppkey")))
    return lines.select(
        F.col("owner").alias("EnterpriseNumber"),
        blank_if(F.col("o_custkey") % 9 == 0, code).alias("nace_code"),
        line_order(lines),
    )


def raw_contact(spark: SparkSession, sf_dir: str, in_order: bool = False) -> DataFrame:
    event, kind = F.col("event_id"), F.col("event_type")
    of_place = kind.isin("click", "view")
    wide = kind == "signup"
    events = sorted_if(in_order, table(spark, sf_dir, "events"), "event_id")
    owner_flag = (
        F.when(kind == "click", "EST").when(kind == "view", "vestiging").when(wide, "").otherwise("ENT")
    )
    contact_type = (
        F.when(kind == "click", "TEL")
        .when(kind == "view", "EMAIL")
        .when(kind == "purchase", "web")
        .when(kind == "error", F.when(event % 2 == 0, "FAX").otherwise("TEL"))
        .otherwise("")
    )
    phone = F.when(wide & (event % 3 == 0), F.concat(F.lit("+32"), event)).otherwise("")
    email = F.when(wide & (event % 3 == 1), F.concat(F.lit("u"), event, F.lit("@x.example"))).otherwise("")
    person = F.col("user_id") * 10 + event % 10
    return events.select(
        F.when(of_place, dotted("2.", event)).otherwise(dotted("0", person)).alias("EntityNumber"),
        owner_flag.alias("EntityContact"),
        contact_type.alias("ContactType"),
        blank_if(wide | (event % 11 == 0), F.concat(F.lit("v"), event)).alias("Value"),
        phone.alias("phone"),
        email.alias("email"),
        ordered(events, "event_id"),
    )


def raw_denomination(spark: SparkSession, sf_dir: str, in_order: bool = False) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    lines = owned_lines(spark, sf_dir).join(part, F.col("l_partkey") == F.col("p_partkey"))
    lines = sorted_if(in_order, lines, *LINE_KEYS)
    name_type = F.when(F.col("l_returnflag") == "N", "001").when(F.col("l_returnflag") == "R", "002").otherwise("003")
    return lines.select(
        F.col("owner").alias("EntityNumber"),
        blank_if(F.col("o_custkey") % 7 == 0, F.col("p_name")).alias("Denomination"),
        name_type.alias("TypeOfDenomination"),
        pick(LANGUAGES, F.col("l_suppkey")).alias("Language"),
        line_order(lines),
    )


RAW_TABLES = {
    "enterprise": raw_enterprise,
    "establishment": raw_establishment,
    "address": raw_address,
    "activity": raw_activity,
    "contact": raw_contact,
    "denomination": raw_denomination,
}


def raw(spark: SparkSession, sf_dir: str, name: str, in_order: bool = False) -> DataFrame:
    """One raw table under canonical column names, sorted by ``_ord`` if asked for."""
    return canonical_columns(RAW_TABLES[name](spark, sf_dir, in_order))


def registry(spark: SparkSession, sf_dir: str, *tables: str) -> Registry:
    """The bound registry, with all tables or only the named ones."""
    return registry_of({name: raw(spark, sf_dir, name) for name in tables or RAW_TABLES}, SNAPSHOT)
