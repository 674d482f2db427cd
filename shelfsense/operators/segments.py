"""User segments and product sales by period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.functions.labels import segment_name
from shelfsense.operators.positions import global_position

USERS_PER_LIST = 1_000


def units_per_user(purchases: DataFrame, user: str = "user_tag", units: str = "units") -> DataFrame:
    return purchases.groupBy(user).agg(F.sum(units).alias("total_units"))


def share_at_most(totals: DataFrame, value: str, k: float) -> DataFrame:
    """Number and share of rows with ``value <= k``."""
    inside = (F.col(value) <= k).cast("int")
    return totals.agg(F.sum(inside).alias("n_users"), F.avg(inside).alias("share"))


def user_segments(purchases: DataFrame, user: str = "user_tag", units: str = "units") -> DataFrame:
    """``(user, total_units, segment)``; segment is null where no rule holds the total."""
    return units_per_user(purchases, user, units).withColumn("segment", segment_name(F.col("total_units")))


def segment_lists(segments: DataFrame, user: str = "user_tag", size: int = USERS_PER_LIST) -> DataFrame:
    """Sorted user lists per segment as JSON text: ``(segment, list_no, json)``.

    A segment is cut into lists of ``size`` users: a list of all its users could be a third of them.
    """
    placed = global_position(segments.where("segment is not null").select("segment", user), ["segment", user])
    starts = placed.groupBy("segment").agg(F.min("position").alias("start"))
    numbered = placed.join(F.broadcast(starts), "segment").withColumn(  # one row per named segment
        "list_no", F.floor((F.col("position") - F.col("start")) / size)
    )
    lists = numbered.groupBy("segment", "list_no").agg(F.sort_array(F.collect_list(user)).alias("users"))
    return lists.select("segment", "list_no", F.to_json(F.struct("segment", "users")).alias("json"))


def purchases_per_day(purchases: DataFrame, date: str = "date") -> DataFrame:
    return purchases.groupBy(date).agg(F.count(F.lit(1)).alias("n"))


def season_units(
    purchases: DataFrame,
    periods: Sequence[tuple[str, str, str]],
    item: str = "item_id",
    units: str = "units",
    date: str = "date",
) -> DataFrame:
    """Units of each item in each named period ``(name, first day, last day)``; periods may overlap."""
    inside = {name: F.col(date).between(F.lit(a).cast("date"), F.lit(b).cast("date")) for name, a, b in periods}
    any_period = F.lit(False)
    for test in inside.values():
        any_period = any_period | test
    names = F.array_compact(F.array(*[F.when(test, name) for name, test in inside.items()]))
    return (
        purchases.where(any_period)
        .withColumn("period", F.explode(names))
        .groupBy("period", item)
        .agg(F.sum(units).alias("total_units"))
    )


def exact_units(totals: DataFrame, amounts: Sequence[float] = (1, 2, 3, 12), value: str = "total_units") -> DataFrame:
    """Items sold in exactly one of the listed amounts."""
    return totals.where(F.col(value).isin([float(a) for a in amounts]))
