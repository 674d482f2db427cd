"""Purchases to labelled rating triples in one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.operators.binning import assign_bins, bin_edges
from shelfsense.operators.filters import keep_classes
from shelfsense.operators.pseudo_ratings import relative_rating
from shelfsense.sources.session import stored


def rated_purchases(
    purchases: DataFrame,
    products: DataFrame,
    classes: Sequence[str],
    min_purchases: int = 5,
    bulk_units: float = 10,
) -> DataFrame:
    """``(user_tag, item_id, klass, rating)`` of active, returning users, without bulk purchases.

    Users need ``min_purchases`` rows and two purchase dates among the listed classes; bulk rows
    count for these tests and are dropped after them. All tests run on rows grouped by (user, item,
    class), so the purchases are read once and cross the network once, already combined.
    """
    kept = purchases.join(keep_classes(products, classes).select("item_id", "klass"), "item_id")
    small = F.col("units") < bulk_units
    per_item = kept.groupBy("user_tag", "item_id", "klass").agg(
        F.count(F.lit(1)).alias("n_all"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count_if(small).alias("n_rows"),
        F.sum(F.when(small, F.col("units"))).alias("bottles"),
    )
    of_user = Window.partitionBy("user_tag")
    of_class = Window.partitionBy("user_tag", "klass")
    return (
        per_item.repartition("user_tag")  # a user has at most one row per product by now
        .withColumn("_purchases", F.sum("n_all").over(of_user))
        .withColumn("_first", F.min("first_date").over(of_user))
        .withColumn("_last", F.max("last_date").over(of_user))
        .withColumn("_all", F.sum("n_rows").over(of_user))
        .withColumn("_class", F.sum("n_rows").over(of_class))
        .where((F.col("_purchases") >= min_purchases) & (F.col("_first") < F.col("_last")) & (F.col("n_rows") > 0))
        .select(
            "user_tag", "item_id", "klass",
            relative_rating(F.col("bottles"), F.col("_class"), F.col("_all")).alias("rating"),
        )
    )


def prepared_ratings(
    purchases: DataFrame,
    products: DataFrame,
    classes: Sequence[str],
    min_purchases: int = 5,
    bulk_units: float = 10,
    n_bins: int = 10,
) -> DataFrame:
    """``rated_purchases`` with an equal-count label 1..n_bins.

    The ratings are read twice (edges, labels), so they are written to the shared folder between.
    """
    rated = stored(rated_purchases(purchases, products, classes, min_purchases, bulk_units), "rated")
    return assign_bins(rated, "rating", bin_edges(rated, "rating", n_bins))
