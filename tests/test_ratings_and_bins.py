"""Known answers for pseudo-ratings, bins, segments and text; the bin rule against a plain loop."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfsense.functions.text import clean_text, decode_bytes, repair_text
from shelfsense.operators import binning, filters, pseudo_ratings, segments
from shelfsense.operators.positions import global_position, quantiles
from shelfsense.plans.prepare import rated_purchases


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_pseudo_rating(spark):
    bought = spark.createDataFrame(
        [("u", 1, "Red", 2.0), ("u", 1, "Red", 1.0), ("u", 2, "Red", 4.0), ("u", 3, "White", 1.0)],
        "user_tag string, item_id long, klass string, units double",
    )
    got = rows(pseudo_ratings.pseudo_ratings(pseudo_ratings.units_per_item(bought)), "item_id", "rating")
    assert got == [(1, 0.75), (2, 1.083333), (3, 0.75)]
    stats = pseudo_ratings.user_class_stats(bought, ["Red", "White"]).first()
    assert (stats.freq_Red, stats.freq_White, stats.total_Red, stats.total_White) == (0.75, 0.25, 3, 1)


def test_user_tests_come_before_the_bulk_filter(spark):
    bought = spark.createDataFrame(
        [("a", i, 50.0 if i < 4 else 1.0, f"2020-01-0{1 + i % 2}") for i in range(5)]  # 5 rows, 4 of them bulk
        + [("b", i, 1.0, "2020-01-01") for i in range(6)]  # one date only
        + [("c", i, 1.0, f"2020-01-0{i + 1}") for i in range(4)],  # too few
        "user_tag string, item_id long, units double, date string",
    ).withColumn("date", F.col("date").cast("date"))
    products = spark.createDataFrame([(i, "Red") for i in range(6)], "item_id long, klass string")
    assert rows(rated_purchases(bought, products, ["Red"]), "user_tag", "item_id", "rating") == [("a", 4, 0.0)]


def test_edges_and_labels_of_twelve_values(spark):
    values = spark.range(1, 13).select(F.col("id").cast("double").alias("v"))
    edges = binning.bin_edges(values, "v", 3)
    assert rows(edges, "bin", "lo", "hi") == [(1, 1, 5), (2, 7, 10), (3, 12, 12)]
    labels = rows(binning.assign_bins(values, "v", edges), "v", "label")
    assert [label for _, label in labels] == [1] * 5 + [2] * 5 + [3] * 2


def edges_by_loop(values, n_bins):
    """The rule as stated: fill a bin with n // bins + 1 values, leave one out, go on."""
    limit, bins, fill = len(values) // n_bins, {}, 0
    number = 1
    for value in sorted(values):
        if fill <= limit:
            bins.setdefault(number, []).append(value)
        else:
            number, fill = number + 1, 0
        fill += 1
    return sorted((k, min(v), max(v)) for k, v in bins.items())


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 20), min_size=1, max_size=80), st.sampled_from([3, 10]))
def test_edges_agree_with_a_loop(spark, values, n_bins):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    edges = binning.bin_edges(df, "v", n_bins)
    assert rows(edges, "bin", "lo", "hi") == edges_by_loop([float(v) for v in values], n_bins)
    labels = [label for _, label in rows(binning.assign_bins(df, "v", edges), "v", "label")]
    assert labels == sorted(labels) and len(labels) == len(values)


def test_labels_of_nulls_and_of_nothing(spark):
    df = spark.createDataFrame([(None,), (1.0,)], "v double")
    edges = binning.bin_edges(df, "v", 3)
    assert {r.v: r.label for r in binning.assign_bins(df, "v", edges).collect()} == {None: None, 1.0: 1}
    empty = df.limit(0)
    assert binning.assign_bins(empty, "v", binning.bin_edges(empty, "v", 3)).count() == 0


def test_quantiles_with_a_dominant_value(spark):
    values = [5.0] * 500 + list(np.linspace(0, 9, 700))
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(7)
    got = dict(rows(quantiles(df, "v", [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]), "probability", "quantile"))
    for p, q in got.items():
        assert q == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_global_position_is_the_sorted_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"))
    placed = global_position(df.repartition(9), ["k"])
    assert rows(placed, "position", "k") == list(enumerate(sorted(r.k for r in df.collect())))


def test_segments(spark):
    totals = [1, 6, 7, 11, 12, 13, 24, 25, 26, 100, 101]
    bought = spark.createDataFrame([(f"u{t}", float(t)) for t in totals], "user_tag string, units double")
    named = {int(r.total_units): r.segment for r in segments.user_segments(bought).collect()}
    assert named == {
        1: "one", 6: "six", 7: "seven_eleven", 11: "seven_eleven", 12: "twelve", 13: "thirteen_twentyfour",
        24: "thirteen_twentyfour", 25: "twentyfive", 26: "twentysix_onehundred", 100: "twentysix_onehundred",
        101: "onehundred_plus",
    }


def test_segment_lists_are_bounded_and_whole(spark):
    users = spark.range(0, 2500).select(F.format_string("u%05d", "id").alias("user_tag"), F.lit("one").alias("segment"))
    lists = segments.segment_lists(users).select("list_no", F.from_json("json", "users array<string>").users.alias("u"))
    got = {r.list_no: r.u for r in lists.collect()}
    assert sorted(len(u) for u in got.values()) == [500, 1000, 1000]
    assert [u for k in sorted(got) for u in got[k]] == [f"u{i:05d}" for i in range(2500)]


def test_season_periods_may_overlap(spark):
    bought = spark.createDataFrame([(1, 2.0, "2020-12-31"), (1, 3.0, "2021-01-01")], "item_id long, units double, date string")
    bought = bought.withColumn("date", F.col("date").cast("date"))
    got = segments.season_units(bought, [("dec", "2020-12-01", "2020-12-31"), ("turn", "2020-12-31", "2021-01-01")])
    assert rows(got, "period", "item_id", "total_units") == [("dec", 1, 2.0), ("turn", 1, 5.0)]


def test_text_repair(spark):
    raw = spark.createDataFrame([(b"caf\xe9",), (b"caf\xc3\xa9",), (b"plain",)], "raw binary")
    assert [r[0] for r in raw.select(decode_bytes(F.col("raw"))).collect()] == ["café", "café", "plain"]
    twice = spark.createDataFrame([(b"caf\xc3\x83\xc2\xa9",)], "raw binary")
    assert twice.select(clean_text(F.col("raw"))).first()[0] == "café"
    words = ["CafÃ©", "Café", "Ã", "日本 Ã©", None, ""]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(repair_text(F.col("w"))).collect()
    assert [r[0] for r in got] == ["Café", "Café", "Ã", "日本 Ã©", None, ""]


def test_retention_and_rejects(spark):
    before = spark.createDataFrame(
        [("a", "Red", 1), ("a", "Red", 2), ("b", None, 1), ("c", "Beer", 1)], "user_tag string, klass string, date int"
    )
    report = filters.retention(before, F.col("n_purchases") > 1).first()
    assert (report.users_before, report.users_after, report.purchases_percent) == (3, 1, 50.0)
    assert filters.retention(before.limit(0), F.col("n_purchases") > 1).first().users_percent is None
    assert rows(filters.class_rejects(before, ["Red"]), "user_tag") == [("b",), ("c",)]
