"""The mean-rating baseline, scored from pre-aggregated counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsense.functions.hashing import key_fraction
from shelfsense.operators.spread import spread_join

DIGITS = 6


def item_count_mean(ratings: DataFrame, item: str = "item_id", rating: str = "rating") -> DataFrame:
    """Number of ratings and mean rating of each item."""
    return ratings.groupBy(item).agg(
        F.count(F.lit(1)).alias("n_ratings"), F.round(F.avg(rating), DIGITS).alias("mean_rating")
    )


def predict_item_mean(train: DataFrame, pairs: DataFrame, item: str = "item_id") -> DataFrame:
    """Pairs with the mean training rating of their item; items not seen in training are left out."""
    means = item_count_mean(train, item).select(item, F.col("mean_rating").alias("prediction"))
    return spread_join(pairs, means, [item])


def item_mean_rmse(train: DataFrame, test: DataFrame, item: str = "item_id", rating: str = "rating") -> DataFrame:
    """Error of the item means on test rows, which meet the means as counts per (item, rating)."""
    counts = test.groupBy(item, rating).agg(F.count(F.lit(1)).alias("n"))
    means = item_count_mean(train, item).select(item, F.col("mean_rating").alias("prediction"))
    scored = counts.join(means, item)
    error = F.sum(F.col("n") * F.pow(F.col(rating) - F.col("prediction"), F.lit(2)))
    return scored.agg(F.sum("n").alias("n_pairs"), F.sqrt(error / F.sum("n")).alias("rmse"))


def mean_learning_curve(
    ratings: DataFrame, keys: Sequence[str], means_of: Sequence[str], rating: str, train_fractions: Sequence[float]
) -> DataFrame:
    """Train and test RMSE of a mean per ``means_of`` key, for nested train fractions.

    One grouping of the table: each key keeps count, sum and sum of squares of its ratings below
    every fraction, from which the squared error of any mean follows.
    """
    at, value = F.col("_at"), F.col(rating).cast("double")

    def moments(inside: Column) -> Column:
        return F.struct(
            F.count_if(inside).alias("n"),
            F.sum(F.when(inside, value)).alias("s"),
            F.sum(F.when(inside, value * value)).alias("q"),
        )

    sums = {f"_{i}": moments(at < F.lit(f)) for i, f in enumerate(train_fractions)}
    # a column of its own, so that the hash is taken once per row and not once per fraction
    per_key = ratings.withColumn("_at", key_fraction(keys)).groupBy(*means_of).agg(
        *[c.alias(name) for name, c in sums.items()], moments(F.lit(True)).alias("_whole")
    )

    def errors(name: str, fraction: float) -> Column:
        n, s, q = (F.col(f"{name}.{field}") for field in "nsq")
        rest_n, rest_s, rest_q = (F.col(f"_whole.{field}") - F.col(f"{name}.{field}") for field in "nsq")
        mean = F.round(s / n, DIGITS)

        def squared(count: Column, total: Column, squares: Column) -> Column:
            return squares - 2 * mean * total + mean * mean * count

        return F.when(n > 0, F.struct(
            F.lit(fraction).alias("train_fraction"),
            n.alias("n_train"), squared(n, s, q).alias("train"),
            rest_n.alias("n_test"), squared(rest_n, rest_s, rest_q).alias("test"),
        ))

    points = F.array_compact(F.array(*[errors(f"_{i}", f) for i, f in enumerate(train_fractions)]))
    return per_key.select(F.explode(points).alias("p")).groupBy(F.col("p.train_fraction").alias("train_fraction")).agg(
        F.sqrt(F.sum("p.train") / F.sum("p.n_train")).alias("train_rmse"),
        F.sqrt(F.sum("p.test") / F.nullif(F.sum("p.n_test"), F.lit(0))).alias("test_rmse"),
    )
