"""Global order without a single-task sort: range partitions, then one offset per partition."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.sources.session import cut_lineage

_SLOT_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in its low 33 bits


def _ranged(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``df`` range-partitioned and sorted, with its partition and row number fixed on disk.

    The range bounds come from a sample, so the layout must not be computed a second time.
    """
    laid_out = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    at = F.col("_at")
    return (
        cut_lineage(laid_out)
        .withColumn("_part", F.shiftright(at, _SLOT_BITS))
        .withColumn("_slot", at.bitwiseAND(F.lit((1 << _SLOT_BITS) - 1)))
        .drop("_at")
    )


def _offsets(ranged: DataFrame, weight: Column) -> DataFrame:
    """Weight before each partition and in all of them; one row per partition, so one task is enough."""
    in_order = Window.orderBy("_part")
    return ranged.groupBy("_part").agg(F.sum(weight).alias("_held")).select(
        "_part",
        "_held",
        (F.sum("_held").over(in_order) - F.col("_held")).alias("_before"),
        F.sum("_held").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"),
    )


def global_position(df: DataFrame, order: Sequence[Column | str], into: str = "position") -> DataFrame:
    """Add the 0-based place of each row in the order of ``order``, whose values must be unique."""
    ranged = _ranged(df, order)
    offsets = F.broadcast(_offsets(ranged, F.lit(1)).select("_part", "_before"))  # one row per partition
    placed = ranged.join(offsets, "_part").withColumn(into, F.col("_before") + F.col("_slot"))
    return placed.drop("_part", "_slot", "_before")


def values_at_ranks(df: DataFrame, value: str, targets: Callable[[Column], Column]) -> DataFrame:
    """The values found at some 0-based ranks of the sorted, non-null ``value`` column.

    ``targets`` turns the row count into an array of structs with a ``rank`` field. Returns
    ``(target, value, n_rows)``. Equal values are counted first, so a value that fills a third of
    the table is one row; only range partitions that hold a target are read again.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    ranged = _ranged(counted, ["value"])
    held = (F.col("_before"), F.col("_before") + F.col("_held"))
    offsets = _offsets(ranged, F.col("_n")).withColumn(
        "_wanted", F.filter(targets(F.col("_all")), lambda t: (t["rank"] >= held[0]) & (t["rank"] < held[1]))
    )
    within = Window.partitionBy("_part").orderBy("_slot")
    last = F.col("_before") + F.sum("_n").over(within)
    placed = (
        ranged.join(F.broadcast(offsets.where(F.size("_wanted") > 0)), "_part")  # one row per partition
        .withColumn("_end", last)
        .withColumn(
            "_hit",
            F.filter("_wanted", lambda t: (t["rank"] >= F.col("_end") - F.col("_n")) & (t["rank"] < F.col("_end"))),
        )
    )
    return placed.select(F.explode("_hit").alias("target"), "value", F.col("_all").alias("n_rows"))


def quantiles(df: DataFrame, value: str, probabilities: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation: ``(probability, quantile)``."""

    def ranks(n: Column) -> Column:
        wanted = []
        for p in probabilities:
            place = F.lit(float(p)) * (n - 1)
            wanted.append((p, F.floor(place), 1.0 - (place - F.floor(place))))
            wanted.append((p, F.floor(place) + 1, place - F.floor(place)))
        return F.array(*[
            F.struct(
                F.lit(float(p)).alias("probability"), rank.cast("long").alias("rank"), share.alias("share")
            )
            for p, rank, share in wanted
        ])

    found = values_at_ranks(df, value, ranks)
    return found.groupBy(F.col("target.probability").alias("probability")).agg(
        F.sum(F.col("value") * F.col("target.share")).alias("quantile")
    )
