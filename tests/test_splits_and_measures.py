"""Splits, samples, confusion counts, curves and errors."""

import pytest
from pyspark.sql import functions as F

from shelfsense.operators import accuracy, baseline, sampling


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(0, 3000).withColumnRenamed("id", "k")
    first = {r.k for r in sampling.split_by_weights(df.repartition(3), ["k"], [8, 2]).where("part = 1").collect()}
    second = {r.k for r in sampling.split_by_weights(df.repartition(11), ["k"], [8, 2]).where("part = 1").collect()}
    assert first == second and 450 < len(first) < 750


def test_parts_are_disjoint_and_whole(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    parts = sampling.split_by_weights(df, ["k"], [6, 2, 2]).groupBy("part").count().collect()
    assert {r.part for r in parts} == {0, 1, 2} and sum(r["count"] for r in parts) == 1000


@pytest.mark.parametrize("n", [0, 1, 17, 400, 401, 5000])
def test_sample_has_exactly_n_rows(spark, n):
    df = spark.range(0, 401).withColumnRenamed("id", "k").repartition(5)
    got = {r.k for r in sampling.sample_rows(df, ["k"], n).collect()}
    assert len(got) == min(n, 401)
    if 0 < n < 401:  # samples are nested
        assert got >= {r.k for r in sampling.sample_rows(df, ["k"], n - 1).collect()}


def test_stratified_split_keeps_shares_with_one_dominant_label(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("k"), F.when(F.col("id") < 700, 1).otherwise(F.col("id") % 4 + 2).alias("label"))
    sizes = sampling.split_stratified(df, ["k"], "label", 0.3).groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")
    ).collect()
    assert {r.label: (r.n, r.t) for r in sizes} == {1: (700, 210), 2: (75, 23), 3: (75, 23), 4: (75, 23), 5: (75, 23)}


def test_seeds_differ(spark):
    df = spark.range(0, 300).withColumnRenamed("id", "k")
    one, two = ([r.k for r in sampling.shuffled(df, ["k"], seed=s).orderBy("position").collect()] for s in (4, 5))
    assert one != two and sorted(one) == sorted(two) == list(range(300))


PAIRS = [(9, 9.5), (9, 3.0), (2, 8.0), (2, 1.0)]


def test_confusion_at_one_threshold(spark):
    pairs = spark.createDataFrame(PAIRS, "rating int, prediction double")
    counts = {r.threshold: r for r in accuracy.confusion_by_threshold(pairs, thresholds=[5.0, 10.0]).collect()}
    five = counts[5.0]
    assert (five.tp, five.fn, five.fp, five.tn, five.tpr, five.fpr) == (1, 1, 1, 1, 0.5, 0.5)
    assert counts[10.0].tpr is None
    for row in counts.values():
        assert row.tp + row.fp + row.fn + row.tn == len(PAIRS)
    points = {(r.fpr, r.tpr) for r in accuracy.roc_points(accuracy.confusion_by_threshold(pairs, thresholds=[5.0, 10.0])).collect()}
    assert points == {(1.0, 1.0), (0.5, 0.5), (0.0, 0.0)}


def test_curve_without_pairs_is_its_end_points(spark):
    none = spark.createDataFrame([], "rating int, prediction double")
    points = accuracy.roc_points(accuracy.confusion_by_threshold(none))
    assert points.count() == 2 and accuracy.auc(points).first().auc == 0.5


@pytest.mark.parametrize("points, area", [([(0.0, 0.0), (0.5, 0.5), (1.0, 1.0)], 0.5), ([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)], 1.0)])
def test_area(spark, points, area):
    assert accuracy.auc(spark.createDataFrame(points, "fpr double, tpr double")).first().auc == area


def test_activity_levels_are_cumulative(spark):
    pairs = spark.createDataFrame(
        [(u, i, 5, 6.0) for u, n in ((1, 2), (2, 3), (3, 12)) for i in range(n)],
        "user_id long, item_id long, rating int, prediction double",
    )
    sizes = accuracy.activity_rates(pairs, "user_id").where("threshold = 5").selectExpr("min_pairs", "tp + fp + fn + tn AS n")
    got = {r.min_pairs: r.n for r in sizes.collect()}
    assert got == {3: 15, **{k: 12 for k in range(4, 11)}}


def test_density_counts_pairs_once(spark):
    pairs = [(1, 1), (1, 1), (1, 2), (2, 3), (2, 4), (3, 1), (3, 4)]
    df = spark.createDataFrame(pairs, "u long, i long")
    assert accuracy.density(df, "u", "i").first().density == 0.5


def test_item_means_and_their_error(spark):
    train = spark.createDataFrame([(1, 3.0), (1, 5.0), (2, 2.0)], "item_id long, rating double")
    means = {r.item_id: (r.n_ratings, r.mean_rating) for r in baseline.item_count_mean(train).collect()}
    assert means == {1: (2, 4.0), 2: (1, 2.0)}
    test = spark.createDataFrame([(1, 1.0), (1, 4.0), (9, 1.0)], "item_id long, rating double")
    error = baseline.item_mean_rmse(train, test).first()
    assert error.n_pairs == 2 and error.rmse == pytest.approx((9 / 2) ** 0.5)


def test_set_sizes(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (3,)], "user_id long")
    right = spark.createDataFrame([(1,), (2,), (4,)], "user_id long")
    assert [tuple(r) for r in accuracy.set_size_mismatch(left, right, "user_id").collect()] == [(1, 2, 1)]
