"""Joins of purchases, ratings and recommendations with their lookup tables.

The size of a lookup table is Spark's to check, at planning and again at run time. A hot key is
split by the skew-join settings of ``sources.session`` where both sides are shuffled for the join,
and by ``spread_join`` where one side was aggregated on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.operators.positions import global_position
from shelfsense.operators.spread import spread_join

ID_STEP = 100  # fixed value: user ids are 0, 100, 200, ...


def user_bridge(ratings: DataFrame, tag: str = "user_tag", into: str = "user_id", step: int = ID_STEP) -> DataFrame:
    """One integer id per distinct tag, in the order of the sorted tags.

    ALS takes 32-bit ids; with more than 21 million users use ``step=1``.
    """
    placed = global_position(ratings.select(tag).distinct(), [tag], into)
    return placed.select(tag, (F.col(into) * step).cast("long").alias(into))


def to_user_ids(ratings: DataFrame, bridge: DataFrame, tag: str = "user_tag") -> DataFrame:
    return ratings.join(bridge, tag).drop(tag)


def to_user_tags(rows: DataFrame, bridge: DataFrame, user_id: str = "user_id") -> DataFrame:
    return rows.join(bridge, user_id).drop(user_id)


def with_products(rows: DataFrame, products: DataFrame, item: str = "item_id") -> DataFrame:
    """Rows with the attributes of their item; rows of unknown items are left out."""
    return rows.join(products, item)


def with_class(purchases: DataFrame, products: DataFrame, item: str = "item_id", klass: str = "klass") -> DataFrame:
    """Every purchase with its product class, null for unknown items."""
    return purchases.join(products.select(item, klass), item, "left")


def with_group_size(rows: DataFrame, key: str, into: str = "n_rows") -> DataFrame:
    """Every row with the number of rows of its key. Counts are formed before the join, not in a window."""
    return spread_join(rows, rows.groupBy(key).agg(F.count(F.lit(1)).alias(into)), [key])


def common_users(test: DataFrame, predicted: DataFrame, user: str = "user_id") -> DataFrame:
    """Test rows of users that have a prediction."""
    return spread_join(test, predicted.select(user).distinct(), [user], "left_semi")


def common_pairs(test: DataFrame, predicted: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Test rows whose user and item have a prediction."""
    return test.join(predicted, [user, item], "left_semi")


def actual_and_predicted(test: DataFrame, predicted: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    return test.join(predicted, [user, item])
