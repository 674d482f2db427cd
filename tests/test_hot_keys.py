"""One key with half of the rows: it must be dealt to several tasks and no row may be lost."""

import pytest
from pyspark.sql import functions as F

from shelfsense.operators.joins import with_products
from shelfsense.operators.spread import hot_keys, spread_join

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
TINY_SKEW = {
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def settings(spark):
    wanted = {**NO_BROADCAST, **TINY_SKEW}
    before = {n: spark.conf.get(n, None) for n in wanted}
    for n, v in wanted.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


@pytest.fixture(scope="module")
def rows(spark):
    """Half of the rows share key -1, and half of those are copies of one row."""
    key = F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id") % 1000)
    value = F.when(F.col("id") % 4 == 0, 0).otherwise(F.col("id"))
    return spark.range(0, 40_000, 1, 8).select(key.alias("k"), value.alias("v"), F.lit("x").alias("filler"))


def test_only_the_hot_key_is_found(rows):
    assert [tuple(r) for r in hot_keys(rows, ["k"], hot_rows=1000).collect()] == [(-1, 20)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_a_plain_join(rows, settings, how):
    keyed = rows.groupBy("k").agg(F.max("v").alias("top")).where("k < 500")
    plain = rows.join(keyed, ["k"], how)
    dealt = spread_join(rows, keyed, ["k"], how, hot_rows=1000)
    assert dealt.columns == plain.columns
    assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()


def test_hot_key_and_its_copies_reach_many_tasks(rows, settings):
    keyed = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    dealt = spread_join(rows, keyed, ["k"], hot_rows=1000).withColumn("task", F.spark_partition_id())
    tasks = dealt.where("k = -1").groupBy("task").count().collect()
    assert len(tasks) >= 6 and sum(r["count"] for r in tasks) == 20_000
    assert max(r["count"] for r in tasks) < 8_000
    copies = dealt.where("k = -1 and v = 0").groupBy("task").count().collect()
    assert len(copies) > 1 and sum(r["count"] for r in copies) == 10_000


def test_lookup_tables_leave_hot_keys_to_spark(spark, settings):
    wide = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("item_id"), "id", F.uuid().alias("filler")
    )
    products = spark.range(-1, 400_000, 1, 8).select(F.col("id").alias("item_id"), F.lit("x").alias("klass"))
    joined = with_products(wide, products)
    assert joined.groupBy("klass").agg(F.count(F.lit(1)).alias("n")).first().n == 400_000
    counted = joined.groupBy("item_id").agg(F.max("filler"))
    assert counted.count() == 200_001
    counted.collect()
    assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
