"""Sketches within their bounds, tables that join without a shuffle, folders that are not read, sparse rows."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the queries
from shelfsense.operators import binning, sketches
from shelfsense.operators.accuracy import density
from shelfsense.plans.validate import user_reports
from shelfsense.registry.core import QUERIES
from shelfsense.sources import layouts
from shelfsense.sources.session import fresh_path


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def values(spark):
    skewed = F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.pow(F.rand(3), F.lit(4)) * 100)
    return spark.range(60_000).select("id", skewed.alias("v"), (F.col("id") % 30).alias("day")).persist()


@pytest.mark.parametrize("merged", [False, True])
def test_edges_of_sketches(values, merged):
    found = sketches.value_sketches(values, "v", ["day"] if merged else [])
    if merged:
        found = sketches.merged_values(found)
    errors = sketches.rank_errors(sketches.sketched_edges(found), values, "v").collect()
    assert {r.bin for r in errors} == set(range(1, 11)) and max(r.error for r in errors) < 0.02


def test_rank_errors_find_a_wrong_edge(spark, values):
    wrong = spark.createDataFrame([(1, 90.0)], "bin int, hi double")
    assert sketches.rank_errors(wrong, values, "v").first().error > 0.5


def test_sketches_of_nothing(spark, values):
    none = values.where("false")
    assert sketches.sketched_edges(sketches.value_sketches(none, "v")).count() == 0
    few = spark.createDataFrame([(1.0,), (2.0,), (None,)], "v double")
    edges = [r.hi for r in sketches.sketched_edges(sketches.value_sketches(few, "v"), 4).orderBy("bin").collect()]
    assert edges == [1.0, 1.0, 2.0, 2.0]


def test_distinct_counts_and_overlaps(spark):
    rows = spark.range(50_000).select((F.col("id") % 20_000).alias("user"), (F.col("id") % 900).alias("item"), (F.col("id") % 5).alias("day"))
    daily = sketches.distinct_sketches(rows, ["user", "item"], ["day"])
    n = sketches.estimates(sketches.merged_distinct(daily, ["user", "item"]), ["user", "item"]).first()
    assert abs(n.n_user - 20_000) < 0.06 * 20_000 and n.n_item == 900
    halves = spark.range(15_000).agg(
        F.theta_sketch_agg(F.when(F.col("id") < 10_000, F.col("id")), 12).alias("a"),
        F.theta_sketch_agg(F.when(F.col("id") >= 5_000, F.col("id")), 12).alias("b"),
    )
    assert abs(halves.select(sketches.overlap(F.col("a"), F.col("b"))).first()[0] - 5_000) < 0.06 * 15_000


def test_counts_do_not_copy_rows(spark, folder):
    assert "Expand" not in physical(QUERIES["global_counts"](spark, folder))
    pairs = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "a")], "u int, i string")
    found = density(pairs, "u", "i")
    assert "Expand" not in physical(found) and tuple(found.first()) == (3, 2, 2, 0.75)


def test_bucketed_tables_join_without_a_shuffle(spark, folder):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    plan = physical(QUERIES["bucketed_bridge_join"](spark, folder))
    left = layouts.bucketed(spark.range(50).withColumn("x", F.col("id") % 7), "left", ["x"], 4)
    grouped = left.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert "Exchange" not in physical(grouped) and grouped.count() == 7


def test_only_the_months_of_the_periods_are_read(spark, folder):
    found = QUERIES["season_units_pruned"](spark, folder)
    assert re.search(r"dynamicpruning", physical(found))
    path = fresh_path(spark, "by-month")
    rows = spark.createDataFrame(
        [("a", 1.0, "2020-01-15"), ("a", 2.0, "2020-02-01"), ("b", 4.0, "2020-03-31"), ("b", 8.0, "2021-01-01"), ("b", 9.0, None)],
        "item_id string, units double, date string",
    ).withColumn("date", F.col("date").cast("date"))
    layouts.write_by_month(rows, path)
    periods = spark.createDataFrame([("x", "2020-01-15", "2020-02-01"), ("y", "2020-02-01", "2020-12-31"), ("none", "2020-02-01", "2020-01-01")],
                                    "period string, first_day string, last_day string")
    periods = periods.select("period", F.col("first_day").cast("date"), F.col("last_day").cast("date"))
    totals = layouts.season_units_by_month(spark, path, periods)
    assert sorted(map(tuple, totals.collect())) == [("x", "a", 3.0), ("y", "a", 2.0), ("y", "b", 4.0)]
    # the folder of another month may be unreadable
    for part in spark.read.parquet(path).where("month = '2021-01-01'").select(F.input_file_name()).distinct().collect():
        name = part[0].removeprefix("file://")
        with open(name, "wb") as broken:
            broken.write(b"not a table")
    spark.catalog.refreshByPath(path)
    schema = spark.read.parquet(f"{path}/month=2020-01-01").schema
    assert schema.fieldNames() == ["item_id", "units", "date"] and totals.count() == 3


def test_sparse_rows_and_back(spark):
    cells = spark.createDataFrame(
        [("u", "b", 2.0), ("u", "a", 1.0), ("v", "c", 3.0), ("v", "c", 4.0), (None, "a", 1.0), ("w", None, 1.0), ("w", "a", None)],
        "r string, c string, x double",
    )
    dictionary = layouts.column_dictionary(cells, "c")
    assert sorted(map(tuple, dictionary.select("c", "place").collect())) == [("a", 0), ("b", 1), ("c", 2)]
    vectors = layouts.sparse_rows(cells, "r", "c", "x", dictionary)
    assert sorted((r.r, list(r.places), list(r["values"])) for r in vectors.collect()) == [("u", [0, 1], [1.0, 2.0]), ("v", [2], [4.0])]
    back = layouts.dense_cells(vectors, "r", dictionary, "c", "x")
    assert sorted(map(tuple, back.collect())) == [("u", "a", 1.0), ("u", "b", 2.0), ("v", "c", 4.0)]
    assert layouts.sparse_rows(cells.where("false"), "r", "c", "x", dictionary).count() == 0


def test_sparse_rows_of_many_columns(spark):
    cells = spark.range(30_000).select((F.col("id") % 10).alias("r"), F.col("id").alias("c"), F.lit(1.0).alias("x"))
    dictionary = layouts.column_dictionary(cells, "c")
    vectors = layouts.sparse_rows(cells, "r", "c", "x", dictionary)
    assert vectors.select(F.sum(F.size("places"))).first()[0] == 30_000
    assert layouts.dense_cells(vectors, "r", dictionary, "c", "x").exceptAll(cells).count() == 0


def test_histograms(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 1.0, 2.5, 10.0, -3.0, 40.0, None)], "v double")
    whole = {r.bin: (r.bin_lo, r.n) for r in binning.histogram_of_data(df, "v", 4).collect()}
    assert whole == {0: (-3.0, 4), 1: (7.75, 1), 3: (29.25, 1)}
    outside = {r.bin: r.n for r in binning.histogram_with_outside(df, "v", 0.0, 10.0, 2).collect()}
    assert outside == {-1: 1, 0: 3, 1: 1, 2: 1, None: 1}
    one = spark.createDataFrame([(7.0,), (7.0,)], "v double")
    assert [(r.bin, r.n) for r in binning.histogram_of_data(one, "v", 4).collect()] == [(0, 2)]
    assert binning.histogram_of_data(df.where("false"), "v", 4).count() == 0


def test_reports_of_all_users(spark):
    pairs = spark.createDataFrame([(u, i, 5, 4.5) for u in "ab" for i in range(6)], "user_tag string, item_id long, rating int, prediction double")
    products = spark.createDataFrame([(i, "Red" if i % 2 else "White") for i in range(6)], "item_id long, klass string")
    rows = user_reports(pairs, products, ["Red"], 2).collect()
    assert sorted((r.user_tag, r["rank"], r.item_id) for r in rows) == [("a", 1, 1), ("a", 2, 3), ("b", 1, 1), ("b", 2, 3)]
    assert user_reports(pairs, products, None, 100).count() == 12
