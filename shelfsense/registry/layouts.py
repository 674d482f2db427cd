"""Queries: sketches against exact answers, bucketed, monthly and sparse tables, whole reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfsense.operators import binning, joins, sketches
from shelfsense.plans.validate import user_reports
from shelfsense.registry.cleaning import _ALL_KEPT, _rating_sql, pseudo_rating
from shelfsense.registry.core import CLASSES, query, stored_triples, test_pairs, with_views
from shelfsense.registry.measuring import _BRIDGE
from shelfsense.registry.profiling import _SEASONS, PERIODS
from shelfsense.sources import layouts, logical
from shelfsense.sources.session import fresh_path, stored

RANK_BOUND = 0.02  # of the rows; four times what the sketch's size promises
DISTINCT_BOUND = 0.06  # of the keys; four deviations


@query(_rating_sql(_ALL_KEPT, "rated", "ranked", "edges")
       + "SELECT bin, source, true AS within FROM edges, (VALUES ('whole'), ('merged')) s(source)")
def bin_edges_sketch(spark, folder):
    """Bin edges from one sketch, and from sketches of a sixteenth of the users each, against the exact ranks."""
    rated = stored(pseudo_rating(spark, folder), "rated")
    batch = F.pmod(F.xxhash64("user_tag"), F.lit(16))
    found = {
        "whole": sketches.value_sketches(rated, "rating"),
        "merged": sketches.merged_values(sketches.value_sketches(rated.withColumn("batch", batch), "rating", ["batch"])),
    }
    errors = [
        sketches.rank_errors(sketches.sketched_edges(s), rated, "rating").select(
            "bin", F.lit(name).alias("source"), (F.col("error") <= RANK_BOUND).alias("within")
        )
        for name, s in found.items()
    ]
    return errors[0].unionByName(errors[1])


@query(with_views("purchases") + """SELECT count(DISTINCT user_tag) AS n_users, count(DISTINCT item_id) AS n_items,
    true AS users_within, true AS items_within, true AS overlap_within FROM purchases""")
def distinct_sketch(spark, folder):
    """Users and items from one sketch per year, merged, and users of both first and last year, against exact counts."""
    rows = logical.purchases(spark, folder).withColumn("year", F.year("date"))
    columns = ["user_tag", "item_id"]
    yearly = stored(sketches.distinct_sketches(rows, columns, ["year"]), "yearly")
    merged = sketches.estimates(sketches.merged_distinct(yearly, columns), columns)
    users, items = (rows.select(c).distinct().agg(F.count(F.lit(1))).scalar() for c in columns)
    ends = yearly.agg(F.min_by("user_tag_sketch", "year").alias("a"), F.max_by("user_tag_sketch", "year").alias("b"))
    shared = ends.select(sketches.overlap(F.col("a"), F.col("b"))).scalar()
    years = rows.where("year IS NOT NULL").groupBy("user_tag").agg(F.min("year").alias("a"), F.max("year").alias("b"))
    first, last = (rows.agg(f("year")).scalar() for f in (F.min, F.max))
    both = years.agg(F.count_if((F.col("a") == first) & (F.col("b") == last))).scalar()
    return merged.select(
        users.alias("n_users"), items.alias("n_items"),
        (F.abs(F.col("n_user_tag") - users) <= DISTINCT_BOUND * users).alias("users_within"),
        (F.abs(F.col("n_item_id") - items) <= DISTINCT_BOUND * items).alias("items_within"),
        (F.abs(shared - both) <= DISTINCT_BOUND * users).alias("overlap_within"),
    )


@query(with_views("purchases", "triples", bridge=_BRIDGE)
       + "SELECT user_tag, item_id, rating, user_id FROM triples JOIN bridge USING (user_tag)")
def bucketed_bridge_join(spark, folder):
    """Ratings and the bridge as tables in buckets of the user: joined without moving either again."""
    ratings = stored_triples(spark, folder)
    left = layouts.bucketed(ratings, "ratings-by-user", ["user_tag"], 8)
    right = layouts.bucketed(joins.user_bridge(ratings), "bridge-by-user", ["user_tag"], 8)
    return left.join(right.hint("merge"), "user_tag").select("user_tag", "item_id", "rating", "user_id")


@query(with_views("purchases", seasons=_SEASONS) + "SELECT * FROM seasons")
def season_units_pruned(spark, folder):
    """Season totals from purchases in folders by month, of which only those of the periods are read."""
    path = fresh_path(spark, "purchases-by-month")
    layouts.write_by_month(logical.purchases(spark, folder), path)
    periods = spark.createDataFrame(PERIODS, "period string, first_day string, last_day string").select(
        "period", F.col("first_day").cast("date"), F.col("last_day").cast("date")
    )
    return layouts.season_units_by_month(spark, path, periods)


@query(with_views("purchases", "triples") + "SELECT user_tag, item_id, rating FROM triples")
def sparse_rating_rows(spark, folder):
    """Ratings as one sparse vector per user over all items, and back to cells."""
    ratings = stored_triples(spark, folder)
    dictionary = layouts.column_dictionary(ratings, "item_id")
    vectors = stored(layouts.sparse_rows(ratings, "user_tag", "item_id", "rating", dictionary), "vectors")
    return layouts.dense_cells(vectors, "user_tag", dictionary, "item_id", "rating")


_PAIRS = ("purchases", "products", "triples", "hashed", "train", "test", "item_means", "pairs")


@query(with_views(*_PAIRS) + """SELECT user_tag, item_id, rating, prediction, product_name, klass, varietal, size, price,
    CAST(row_number() OVER (PARTITION BY user_tag ORDER BY item_id) AS INTEGER) AS rank
FROM pairs JOIN products USING (item_id) WHERE klass IN ('PROMO', 'ECONOMY') QUALIFY rank <= 10""")
def actual_vs_predicted_report(spark, folder):
    """For every user the first ten held-out items of the listed classes, actual and predicted."""
    return user_reports(test_pairs(spark, folder), logical.products(spark, folder), CLASSES, 10)


@query(with_views("purchases", totals="SELECT user_tag, sum(units) AS v FROM purchases GROUP BY user_tag",
                  ends="SELECT min(v) AS lo, max(v) AS hi FROM totals") + """SELECT
    CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) * 20 / (hi - lo)), 19) END AS INTEGER) AS bin, count(*) AS n
FROM totals, ends GROUP BY 1""")
def units_histogram(spark, folder):
    """Users by their units, in twenty bins over the range of the data."""
    totals = logical.purchases(spark, folder).groupBy("user_tag").agg(F.sum("units").alias("v"))
    return binning.histogram_of_data(totals, "v", 20).select("bin", "n")


@query(with_views("purchases", totals="SELECT user_tag, sum(units) AS v FROM purchases GROUP BY user_tag") + """SELECT
    CAST(CASE WHEN v < 100 THEN -1 WHEN v > 600 THEN 10 ELSE least(floor((v - 100) / 50), 9) END AS INTEGER) AS bin,
    count(*) AS n FROM totals GROUP BY 1""")
def units_histogram_outside(spark, folder):
    """Users by their units in ten bins from 100 to 600, with those below and above."""
    totals = logical.purchases(spark, folder).groupBy("user_tag").agg(F.sum("units").alias("v"))
    return binning.histogram_with_outside(totals, "v", 100.0, 600.0, 10)
