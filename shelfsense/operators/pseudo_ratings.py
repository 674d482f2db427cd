"""From purchases to relative ratings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 6  # ratings are rounded before they are ranked, so equal ratings tie


def user_class_stats(purchases: DataFrame, classes: Sequence[str], user: str = "user_tag", klass: str = "klass") -> DataFrame:
    """Per user and listed class: purchase rows (``total_*``) and their share (``freq_*``)."""
    listed = purchases.where(F.col(klass).isin(list(classes)))
    totals = [F.count_if(F.col(klass) == c).alias(f"total_{c}") for c in classes]
    wide = listed.groupBy(user).agg(*totals, F.count(F.lit(1)).alias("_all"))
    shares = [(F.col(f"total_{c}") / F.col("_all")).alias(f"freq_{c}") for c in classes]
    return wide.select(user, *shares, *[f"total_{c}" for c in classes])


def units_per_item(
    purchases: DataFrame, user: str = "user_tag", item: str = "item_id", klass: str = "klass", units: str = "units"
) -> DataFrame:
    """Units and purchase rows of each (user, item, class)."""
    return purchases.groupBy(user, item, klass).agg(
        F.sum(units).alias("bottles"), F.count(F.lit(1)).alias("n_rows")
    )


def relative_rating(bottles: Column, class_rows: Column, all_rows: Column) -> Column:
    """``(bottles - share of the class) / rows of the class``."""
    return F.round((bottles - class_rows / all_rows) / class_rows, DIGITS)


def pseudo_ratings(
    per_item: DataFrame, user: str = "user_tag", item: str = "item_id", klass: str = "klass"
) -> DataFrame:
    """Rating of each (user, item): ``per_item`` is the output of ``units_per_item``.

    Class totals are sums over the already grouped rows, so the purchases are read once and a
    user's group is at most the product catalogue.
    """
    of_class = F.sum("n_rows").over(Window.partitionBy(user, klass))
    of_user = F.sum("n_rows").over(Window.partitionBy(user))
    return (
        per_item.repartition(user)  # serves both windows
        .withColumn("_class", of_class)
        .withColumn("_all", of_user)
        .select(user, item, klass, relative_rating(F.col("bottles"), F.col("_class"), F.col("_all")).alias("rating"))
    )
