"""Approximate bins, distinct counts and overlaps from sketches of bounded size.

A sketch is a few kilobytes however many rows it has seen, and sketches of batches merge into the sketch of all of them:
a stored sketch per day answers for any run of days without reading the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsense.sources.session import cut_lineage

VALUE_SIZE = 800  # entries of a value sketch; ranks are off by less than 0.5 % of the rows, nearly always
DISTINCT_SIZE = 12  # log2 of the entries of a distinct sketch; exact up to 4,096 keys, then off by 1.6 % (one deviation)


# --- values and ranks ---------------------------------------------------------------------------------------

def value_sketches(df: DataFrame, value: str, by: Sequence[str] = (), size: int = VALUE_SIZE) -> DataFrame:
    """``(*by, sketch)``: the distribution of a column, per group. Nulls are not counted."""
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(size)).alias("sketch"))


def merged_values(sketches: DataFrame, by: Sequence[str] = (), size: int = VALUE_SIZE) -> DataFrame:
    """Sketches of batches put together; the same columns as ``value_sketches``."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"))


def sketched_edges(sketches: DataFrame, n_bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, bin, hi)``: about the largest value of each equal-count bin, bins from 1; ``bin_edges`` without ranks.

    Edge k stands at the share k / n_bins of the rows, at most n_bins rows from the exact mode's place. A sketch of no
    rows has no edges.
    """
    fixed = cut_lineage(sketches).where(F.kll_sketch_get_n_double("sketch") > 0)
    edges = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(k / n_bins)) for k in range(1, n_bins + 1)])
    return fixed.select(*by, F.posexplode(edges).alias("_place", "hi")).select(*by, (F.col("_place") + 1).alias("bin"), "hi")


def rank_errors(edges: DataFrame, df: DataFrame, value: str, n_bins: int = 10) -> DataFrame:
    """``(bin, error)``: how far each edge lies from the rank it stands for, as a share of the rows.

    A value that is there many times covers many ranks; an edge is off by the distance to the nearest of them.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    # the edges, one per bin, reach the counts as one array, so no join is needed
    table = cut_lineage(edges).agg(F.collect_list(F.struct("bin", "hi"))).scalar()
    above = counts.withColumn("_edges", table).select("_v", "_n", F.explode(F.filter("_edges", lambda e: e["hi"] >= F.col("_v"))).alias("_e"))
    sums = above.groupBy(F.col("_e.bin").alias("bin"), F.col("_e.hi").alias("hi")).agg(
        F.sum("_n").alias("_through"), F.sum(F.when(F.col("_v") < F.col("_e.hi"), F.col("_n")).otherwise(0)).alias("_below")
    )
    n = counts.agg(F.sum("_n")).scalar()
    target = F.least(F.col("bin") * (F.floor(n / n_bins) + 1), n)
    off = F.greatest(F.col("_below") + 1 - target, target - F.col("_through"), F.lit(0))
    return sums.select("bin", (off / n).alias("error"))


# --- distinct keys and overlaps --------------------------------------------------------------------------

def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), size: int = DISTINCT_SIZE) -> DataFrame:
    """``(*by, <column>_sketch, ...)``: one sketch of the distinct values of each column, in one pass without copies of rows."""
    return df.groupBy(*by).agg(*[F.theta_sketch_agg(c, size).alias(f"{c}_sketch") for c in columns])


def merged_distinct(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = (), size: int = DISTINCT_SIZE) -> DataFrame:
    """The union of batches: keys of several batches count once."""
    return sketches.groupBy(*by).agg(*[F.theta_union_agg(f"{c}_sketch", size).alias(f"{c}_sketch") for c in columns])


def estimates(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(*by, n_<column>, ...)``: about how many distinct values there are."""
    return sketches.select(*by, *[F.theta_sketch_estimate(f"{c}_sketch").alias(f"n_{c}") for c in columns])


def overlap(left: Column, right: Column) -> Column:
    """About how many keys two sketches share. The error goes with the size of the union, not of the overlap."""
    return F.theta_sketch_estimate(F.theta_intersection(left, right))
