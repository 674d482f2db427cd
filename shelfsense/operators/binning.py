"""Equal-count bins of a continuous rating, their edges, and the label of a value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.operators.positions import values_at_ranks


def bin_edges(df: DataFrame, value: str, n_bins: int = 10, skip_closing: bool = True) -> DataFrame:
    """Smallest and largest value of each equal-count bin: ``(bin, lo, hi)``, bins from 1.

    A bin is ``floor(rows / n_bins) + 1`` ranks wide. With ``skip_closing`` the first rank of every
    bin after the first takes no part in the edges (it is the row that closes the bin before); with
    fewer rows than bins only the first bin is left.
    """

    def ends(n: Column) -> Column:
        width = F.floor(n / n_bins) + 1

        def of_bin(k: Column) -> Column:
            skipped = F.when((k > 1) & F.lit(skip_closing), 1).otherwise(0)
            first = (k - 1) * width + skipped
            final = F.least(k * width, n) - 1
            return F.array(
                F.struct(k.alias("bin"), F.lit("lo").alias("end"), first.alias("rank")),
                F.struct(k.alias("bin"), F.lit("hi").alias("end"), final.alias("rank")),
            )

        bins = F.transform(F.sequence(F.lit(1), F.lit(n_bins)), of_bin)
        existing = F.filter(bins, lambda pair: pair[0]["rank"] <= pair[1]["rank"])
        return F.flatten(existing)

    found = values_at_ranks(df, value, ends)
    end = F.col("target.end")
    return found.groupBy(F.col("target.bin").alias("bin")).agg(
        F.max(F.when(end == "lo", F.col("value"))).alias("lo"),
        F.max(F.when(end == "hi", F.col("value"))).alias("hi"),
    )


def assign_bins(df: DataFrame, value: str, edges: DataFrame, into: str = "label") -> DataFrame:
    """Label each value with the lowest bin that reaches it; above the last edge, the last bin.

    The edges (one row per bin) reach the rows as one array, so no join is needed.
    """
    table = edges.agg(F.array_sort(F.collect_list(F.struct("bin", "hi")))).scalar()
    reached = F.get(F.filter("_edges", lambda e: e["hi"] >= F.col(value)), 0)
    last = F.try_element_at("_edges", F.lit(-1))
    label = F.when(F.col(value).isNotNull(), F.coalesce(reached["bin"], last["bin"]))
    return df.withColumn("_edges", table).withColumn(into, label).drop("_edges")


def intervals(edges: DataFrame, group: str, edge: str) -> DataFrame:
    """Neighbouring edges of a group paired into labelled intervals: ``(group, label, lo, hi)``."""
    in_order = Window.partitionBy(group).orderBy(edge)
    return edges.select(
        group,
        (F.row_number().over(in_order) - 1).alias("label"),
        F.col(edge).alias("lo"),
        F.lead(edge).over(in_order).alias("hi"),
    ).where(F.col("hi").isNotNull())


def equal_width_histogram(df: DataFrame, value: str, lo: float, hi: float, n_bins: int) -> DataFrame:
    """Counts per equal-width bin of ``[lo, hi]``: ``(bin, bin_lo, n)``; the last bin holds ``hi``."""
    width = (hi - lo) / n_bins
    place = F.least(F.floor((F.col(value) - lo) / width), F.lit(n_bins - 1)).cast("int")
    return (
        df.where(F.col(value).between(lo, hi))
        .groupBy(place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_lo", F.lit(lo) + F.col("bin") * width)
    )


def histogram_with_outside(df: DataFrame, value: str, lo: float, hi: float, n_bins: int) -> DataFrame:
    """``(bin, n)`` of all rows: equal-width bins of ``[lo, hi]``, bin -1 below, bin ``n_bins`` above, null for null."""
    at, width = F.col(value), (hi - lo) / n_bins
    inside = F.least(F.floor((at - lo) / width), F.lit(n_bins - 1))
    place = F.when(at < lo, -1).when(at > hi, n_bins).when(at.isNotNull(), inside).cast("int")
    return df.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def histogram_of_data(df: DataFrame, value: str, n_bins: int) -> DataFrame:
    """``(bin, bin_lo, n)``: equal-width bins from the smallest to the largest value, which is in the last bin.

    Equal values are all in bin 0; nulls are in none. The range is found in the same job, from the values' counts.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    ends = counts.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi"))).scalar()
    at = counts.withColumn("_ends", ends)
    lo, reach = F.col("_ends.lo"), F.col("_ends.hi") - F.col("_ends.lo")
    place = F.when(reach == 0, 0).otherwise(F.least(F.floor((F.col("_v") - lo) * n_bins / F.nullif(reach, F.lit(0.0))), F.lit(n_bins - 1)))
    bins = at.groupBy(place.cast("int").alias("bin"), (lo + place * reach / n_bins).alias("bin_lo"))
    return bins.agg(F.sum("_n").alias("n"))


def ceil_histogram(df: DataFrame, value: str) -> DataFrame:
    """Counts per value rounded up."""
    return df.groupBy(F.ceil(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def bin_population(df: DataFrame, label: str) -> DataFrame:
    """Rows per bin and their share of all rows."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy()  # as many rows as there are bins
    return counts.withColumn("share", F.col("n") / F.sum("n").over(whole))
