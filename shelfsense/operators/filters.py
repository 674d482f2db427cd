"""Row filters of purchase and product tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsense.functions.labels import safe_ratio
from shelfsense.operators.spread import spread_join


def keep_classes(products: DataFrame, classes: Sequence[str], klass: str = "klass") -> DataFrame:
    """Products of the listed classes."""
    return products.where(F.col(klass).isin(list(classes)))


def class_rejects(rows: DataFrame, classes: Sequence[str], klass: str = "klass") -> DataFrame:
    """Rows whose class is missing or not listed; what a job should report rather than stop on."""
    return rows.where(F.col(klass).isNull() | ~F.col(klass).isin(list(classes)))


def union_classes(products: DataFrame, classes: Sequence[str], klass: str = "klass") -> DataFrame:
    """One filtered branch per class, put together; a class listed twice is kept twice."""
    branches = [products.where(F.col(klass) == name) for name in classes]
    whole = branches[0]
    for branch in branches[1:]:
        whole = whole.unionByName(branch)
    return whole


def drop_bulk(purchases: DataFrame, units: str = "units", k: float = 10) -> DataFrame:
    """Purchases of fewer than ``k`` units."""
    return purchases.where(F.col(units) < k)


def at_least(rows: DataFrame, value: str, threshold: float) -> DataFrame:
    return rows.where(F.col(value) >= threshold)


def between(rows: DataFrame, value: str, lo, hi) -> DataFrame:
    """Closed range; on a date or number column the bounds reach the Parquet scan."""
    return rows.where(F.col(value).between(lo, hi))


def active_users(
    purchases: DataFrame, user: str = "user_tag", item: str = "item_id", minimum: int = 5, distinct_items: bool = False
) -> DataFrame:
    """Users with at least ``minimum`` purchase rows (or distinct items), and how many they have."""
    count = F.countDistinct(item) if distinct_items else F.count(F.lit(1))
    return purchases.groupBy(user).agg(count.alias("n_purchases")).where(F.col("n_purchases") >= minimum)


def repeat_buyers(
    purchases: DataFrame, user: str = "user_tag", date: str = "date", more_than: int = 1
) -> DataFrame:
    """Users with more than ``more_than`` distinct purchase dates.

    For the usual 1, first and last date differ: two running values instead of a distinct set.
    """
    if more_than == 1:
        return purchases.groupBy(user).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi")).where(
            F.col("_lo") < F.col("_hi")
        ).select(user)
    return purchases.groupBy(user).agg(F.countDistinct(date).alias("_n")).where(F.col("_n") > more_than).select(user)


def rows_of(rows: DataFrame, members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys appear in ``members``, which holds a key once."""
    return spread_join(rows, members.select(*keys), keys, "left_semi")


def rows_without(rows: DataFrame, members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys do not appear in ``members``, which holds a key once."""
    return spread_join(rows, members.select(*keys), keys, "left_anti")


def retention(purchases: DataFrame, keep: Column, user: str = "user_tag", date: str = "date") -> DataFrame:
    """Users and purchases before and after a filter on users, and the percentage kept.

    ``keep`` is a condition over a user's ``n_purchases``, ``first_date`` and ``last_date``; both
    sides of the report come from one grouping by user.
    """
    per_user = purchases.groupBy(user).agg(
        F.count(F.lit(1)).alias("n_purchases"), F.min(date).alias("first_date"), F.max(date).alias("last_date")
    )
    sizes = per_user.agg(
        F.count(F.lit(1)).alias("users_before"),
        F.count_if(keep).alias("users_after"),
        F.coalesce(F.sum("n_purchases"), F.lit(0)).alias("purchases_before"),
        F.coalesce(F.sum(F.when(keep, F.col("n_purchases"))), F.lit(0)).alias("purchases_after"),
    )
    return sizes.withColumns({
        "users_percent": safe_ratio(F.col("users_after"), F.col("users_before")) * 100,
        "purchases_percent": safe_ratio(F.col("purchases_after"), F.col("purchases_before")) * 100,
    })
