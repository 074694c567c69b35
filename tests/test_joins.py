import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from firmscout.operators import joins
from firmscout.plans import leads, region
from suite import bindings

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark):
    """One key on a third of the rows, no key on another third."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "HOT").when(n % 9 == 1, "").when(n % 9 == 4, None).otherwise(n.cast("string"))
    left = spark.range(9000).select(key.alias("k"), n.alias("row"), F.struct((n / 100).cast("int").alias("chunk"), n).alias("_ord"))
    right = spark.range(0, 9000, 2).select(n.cast("string").alias("k"), (n * 2).alias("v"))
    return left, right.unionByName(spark.createDataFrame([("HOT", -1)], "k string, v long"))


@pytest.fixture
def shuffled(spark):
    """No broadcast by size, partitions as they are, and a small one counts as skewed."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield
    for name in changed:
        spark.conf.unset(name)


def rows(df, columns):
    return sorted(map(str, df.select(columns).collect()))


def equal_to_the_plain_join(left, right):
    other = right.select("k", F.col("v").cast("string").alias("w")).where("v % 3 <> 0")
    out = joins.attach(left, [right, other], "k")
    want = left.join(right, "k", "left").join(other, "k", "left")
    columns = ["k", "row", "v", "w"]
    assert rows(out, columns) == rows(want, columns)


def test_attach_equals_the_plain_left_join(skewed):
    equal_to_the_plain_join(*skewed)


def test_attach_equals_it_when_all_is_shuffled(skewed, shuffled):
    equal_to_the_plain_join(*skewed)


def test_attach_with_many_frequent_keys(spark, shuffled):
    left = spark.range(60_000).select((F.col("id") % 2000).cast("string").alias("k"), F.col("id").alias("row"), F.struct("id").alias("_ord"))
    equal_to_the_plain_join(left, spark.range(3000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")))


def test_attach_lets_the_hot_key_be_split(skewed, shuffled):
    """A lookup that was aggregated by its key is shuffled again, so that adaptive execution may split the left side."""
    left, right = skewed
    lookup = right.groupBy("k").agg(F.max("v").alias("v"))
    out = joins.attach(left.repartition(20), [lookup], "k")
    out.collect()
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_every_lookup_is_read_once(spark, skewed):
    left, right = skewed
    out = joins.attach(left, [right.groupBy("k").agg(F.max("v").alias("v"))], "k")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 9000, step=2") == 1


def test_keep_and_drop_matching(skewed):
    left, right = skewed
    twice = right.unionByName(right).unionByName(right.select(F.lit("").alias("k"), "v").limit(1))
    kept = {r.row for r in joins.keep_matching(left, twice, "k").collect()}
    assert kept == {r.row for r in left.join(right, "k", "left_semi").collect()}
    out = {r.row for r in joins.drop_matching(left, twice, "k").collect()}
    assert out == {r.row for r in left.collect()} - kept
    assert 1 in out and 4 in out


def test_stage_uses_the_folder_of_the_session(spark, skewed):
    staged = joins.stage(skewed[0])
    assert staged.count() == 9000
    assert spark.conf.get("spark.checkpoint.dir") in joins.checkpoint_dir(spark)


@pytest.mark.parametrize("build", [leads.build_leads, region.region_leads])
@pytest.mark.parametrize("lite", [False, True])
def test_building_a_frame_starts_no_job(spark, build, lite):
    tables = bindings.registry(spark, SMALL)
    context, group = spark.sparkContext, f"lazy-{build.__name__}-{lite}"
    context.setJobGroup(group, group)
    try:
        build(tables, bindings.params(lite=lite))
        assert len(context.statusTracker().getJobIdsForGroup(group)) == 0
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_each_table_is_scanned_a_few_times(spark):
    """As often as there are lookups that need it: no second reading for frequent keys."""
    plan = entry_point.queries()["leads"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    relations = plan.count("Relation [")
    assert relations <= 20, relations


def test_all_reports_read_each_table_as_often_as_one(spark):
    def relations(name):
        return entry_point.queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString().count("Relation [")

    assert relations("run_report") == relations("stage_funnel")
